"""Lake files decoded by Arrow in tasks, a row group at a time.

Files come from many writers: nanosecond stamps, typeless all-NULL columns, numbers in one file and text in another.
Spark lists them, deals out their row groups and joins the rows; a task opens a file by its path through
``pyarrow.fs`` and reads the footer, or the wanted columns of one row group. All values leave as text.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

NAMES = ("source", "metric_name", "timestamp", "value", "label")
FOOTERS = "object_path string, row_group int, columns array<string>, failure string"
ROWS = f"object_path string, {', '.join(f'{name} string' for name in NAMES)}, columns array<string>, failure string"


def opened(path: str) -> pq.ParquetFile:
    system, place = pafs.FileSystem.from_uri(quote(path, safe=string.printable))  # Spark leaves letters like é as they are
    return pq.ParquetFile(system.open_input_file(place), coerce_int96_timestamp_unit="us")


STATISTICS = "object_path string, low timestamp, high timestamp, complete boolean"


def read_time_ranges(files: DataFrame, column: str = "timestamp") -> DataFrame:
    """Smallest and largest stamp of each file in ``object_path`` by its footer; no data page is read.

    ``complete`` is false where a row group has rows but no such statistics (stamps of 96 bits have none).
    """
    stamp = pa.timestamp("us", "UTC")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs, complete = [], [], []
            paths = batch.column(0).to_pylist()
            for path in paths:
                try:
                    groups = opened(path).metadata
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError):  # a store that only Spark reads, or a broken file
                    for found, value in ((lows, None), (highs, None), (complete, False)):
                        found.append(value)
                    continue
                ends = []
                for group in (groups.row_group(g) for g in range(groups.num_row_groups)):
                    if not group.num_rows:
                        continue
                    own = [group.column(c) for c in range(group.num_columns) if group.column(c).path_in_schema == column]
                    found = own[0].statistics if own and own[0].physical_type == "INT64" else None
                    ends.append((found.min, found.max) if found is not None and found.has_min_max else None)
                known = None not in ends and all(isinstance(v, datetime) for end in ends for v in end)
                lows.append(min(low for low, _ in ends) if known and ends else None)
                highs.append(max(high for _, high in ends) if known and ends else None)
                complete.append(known)
            columns = [pa.array(paths, pa.string()), pa.array(lows, stamp), pa.array(highs, stamp), pa.array(complete)]
            yield pa.record_batch(columns, names=["object_path", "low", "high", "complete"])

    return files.select("object_path").mapInArrow(read, STATISTICS)


def read_footers(files: DataFrame) -> DataFrame:
    """A row for every row group of the files in ``object_path``; one without a group for an empty or broken file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    file = opened(path)
                    found += [(path, g, file.schema_arrow.names, None) for g in range(file.num_row_groups)] or [
                        (path, None, file.schema_arrow.names, None)
                    ]
                except Exception as error:  # any damage to a file concerns that file alone
                    found.append((path, None, [], f"{type(error).__name__}: {error}"))
            kinds = (pa.string(), pa.int32(), pa.list_(pa.string()), pa.string())
            columns = list(zip(*found)) if found else [()] * 4
            names = ["object_path", "row_group", "columns", "failure"]
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return files.select("object_path").mapInArrow(read, FOOTERS)


def texts(values: pa.ChunkedArray) -> pa.ChunkedArray:
    """Values as text: stamps as UTC with microseconds, NaN as NULL."""
    kind = values.type
    if pa.types.is_timestamp(kind) or pa.types.is_date(kind):
        stamps = values.cast(pa.timestamp("us", kind.tz if pa.types.is_timestamp(kind) else None), safe=False)
        return pc.strftime(stamps.cast(pa.timestamp("us", "UTC")), format="%Y-%m-%dT%H:%M:%SZ")
    if pa.types.is_floating(kind):
        values = pc.if_else(pc.is_nan(values), None, values)
    return values.cast(pa.string())


def read_row_groups(groups: DataFrame) -> DataFrame:
    """Rows of the row groups in (object_path, row_group, columns), names a file lacks as NULL.

    A row group that can't be read gives one row with ``failure`` set.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = [pa.string()] * (1 + len(NAMES)) + [pa.list_(pa.string()), pa.string()]
        names = ["object_path", *NAMES, "columns", "failure"]
        for batch in batches:
            for path, group, columns in zip(*(batch.column(i).to_pylist() for i in range(3))):
                try:
                    rows = opened(path).read_row_group(group, columns=[name for name in NAMES if name in columns])
                    held = {name: texts(rows.column(name)).combine_chunks() for name in rows.column_names}
                    count, failure = rows.num_rows, None
                except Exception as error:  # any damage to a file concerns that file alone
                    held, count, failure = {}, 1, f"{type(error).__name__}: {error}"
                constants = {"object_path": path, "columns": columns, "failure": failure}
                arrays = [
                    held[name] if name in held else pa.array([constants.get(name)] * count, kind) for name, kind in zip(names, schema)
                ]
                yield pa.record_batch(arrays, names=names)

    return groups.select("object_path", "row_group", "columns").mapInArrow(read, ROWS)
