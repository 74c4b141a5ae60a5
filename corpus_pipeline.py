"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``; each works on everything its predecessor kept.

Defined results: null and empty texts are scored, kept or cut like any other;
rows that repeat an id and its text go the same way, except that the
near-duplicate stage keeps one row for each id; rows with a null id are never
taken for duplicates. Other columns come out as they went in, but ``n_chars``,
if there is one, follows a changed text. Empty tables pass all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wryspark.llm import dartminhash, packing, quality, spans, winnow
from wryspark.llm.common import shared_path, table
from wryspark.llm.queries import vocabulary
from wryspark.session import ensure_checkpoint_dir, ship_package


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the compression classifier scores below 0.5."""
    _ready(spark)
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate class."""
    _ready(spark)
    return dartminhash.without_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated sentence spans out of the texts; no document goes."""
    _ready(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = spans.remove_repeats(docs, carry=tuple(others), by_words=True)

    def column(c: str):
        if c in ("doc_id", "text"):
            return F.col(c)
        old = F.col("carried")[c]
        if c == "n_chars":
            old = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(old)
        return old.alias(c)

    return found.select(*map(column, docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item."""
    _ready(spark)
    return winnow.uncontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the rest into sequences of 2048 tokens, one row per piece."""
    _ready(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), shared_path(spark, "packed"))


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Compression, hashing in Python and tokens can't be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


#: Rows that a Python worker is handed at a time: whole documents, a few kilobytes each as a rule.
ROWS_PER_BATCH = 2000


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_PER_BATCH:
        spark.conf.set(setting, str(ROWS_PER_BATCH))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
