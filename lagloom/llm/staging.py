"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lagloom.session import work_path


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: cuts its lineage, survives lost executors."""
    return staged_at(frame, label)[0]


def staged_at(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``staged``, and the path, for tables that are removed once later ones are written."""
    path = work_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


#: Rows of an Arrow batch between Spark and a task's Python: whole texts, so fewer than Spark's default.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; batches of its texts are kept small for the rest of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string, as tasks have to return it."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def free_name(columns: list[str], name: str) -> str:
    """``name``, or with underscores in front so that no column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
