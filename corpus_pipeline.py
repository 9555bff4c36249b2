"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage takes the rows that the one before kept, texts as that one left them, and returns the columns of
``documents``; only the last adds its own. Null and empty texts are clean, alike to nothing, without secrets and
without tokens, so they pass all stages. Columns beyond those of ``documents`` pass too, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagloom.llm.bpe import map_tokens
from lagloom.llm.decontaminate import clean_documents
from lagloom.llm.jaccard import jaccard_components
from lagloom.llm.queries import TOKEN_DIGEST, TOKENIZER, learning_labels, token_digest
from lagloom.llm.secret_scan import redact
from lagloom.llm.staging import free_name, staged, table
from lagloom.llm.toxicity import THRESHOLD, fit, score


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    own = free_name(docs.columns, "score")
    scored = score(docs, fit(docs, learning_labels(table(spark, sf_dir, "labels"))), own)
    return scored.where(F.col(own) < THRESHOLD).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles, directly or not, the one with the smallest id stays.

    Rows that share an id stay or go together, and of those with equal texts one stays; rows without an id stay.
    """
    kept = jaccard_components(docs.select("doc_id", "text"), size=5, percent=80).where("doc_id = component_id").select("doc_id").distinct()
    nth = free_name(docs.columns, "nth")
    same = Window.partitionBy("doc_id", "text").orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")] or ["doc_id"])
    first = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn(nth, F.row_number().over(same))
    return first.where(F.col(nth) == 1).select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind."""
    return redact(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text, beside the document's other columns.

    A column that the document has under such a name, or under one that the work needs, keeps its name; the stage's own
    gets underscores in front.
    """
    columns = [c for c in docs.columns if c != "text"]
    plain = {c: f"c{i}" for i, c in enumerate(columns)}
    found = map_tokens(docs.select(*[F.col(f"`{c}`").alias(plain[c]) for c in columns], "text"), TOKENIZER, list(plain.values()), token_digest, TOKEN_DIGEST)
    own = [F.col(c).alias(free_name(columns, c)) for c in TOKEN_COLUMNS]
    return found.select(*[F.col(plain[c]).alias(c) for c in columns], *own)


TOKEN_COLUMNS = ("n_tokens", "ids_sha256", "decoded_sha256")

STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("bpe_round_trip", token_stage),
]

#: SQL can't express the models and scans; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
