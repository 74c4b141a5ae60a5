"""Structured Streaming jobs (X-01, X-02).

The reference scores or summarises one typed text at a time; here new
JSON-lines files dropped into a folder are the stream. Scoring and lead
sentences are stateless row maps. The extractive summary needs the corpus's
term weights: they are stored once as a table, and every micro-batch joins its
own terms to it and picks its sentences as a batch job would, so no state is
kept from one batch to the next. No job needs a watermark or a state store;
the ``availableNow`` trigger processes what is there and stops, and the
checkpoint folder makes restarts exactly-once.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import text as T
from ..operators.articles import extractive_summary, lead_sentence
from ..operators.encode import tfidf_apply, tfidf_fit

TEXT_SCHEMA = Ty.StructType([Ty.StructField("row_id", Ty.LongType()), Ty.StructField("text", Ty.StringType())])


def _run(stream: DataFrame, sink: str, checkpoint: str) -> None:
    q = (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def score_stream(spark: SparkSession, source_dir: str, model: PipelineModel, sink: str, checkpoint: str,
                 text_col: str = "text") -> DataFrame:
    """X-01: score every new text with a fitted pipeline; returns the sink."""
    src = spark.readStream.schema(TEXT_SCHEMA).json(source_dir)
    scored = model.transform(src.withColumnRenamed("text", text_col)).select(
        "row_id", F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("p_sarcastic"))
    _run(scored, sink, checkpoint)
    return spark.read.parquet(sink)


def summarise_stream(spark: SparkSession, source_dir: str, sink: str, checkpoint: str) -> DataFrame:
    """X-02: lead-1 summary of every new text; returns the sink."""
    src = spark.readStream.schema(TEXT_SCHEMA).json(source_dir)
    out = src.select("row_id", lead_sentence("text").alias("summary"),
                     T.newline_sentences("text").alias("sentences"))
    _run(out, sink, checkpoint)
    return spark.read.parquet(sink)


def store_term_weights(docs: DataFrame, text_col: str, id_col: str, path: str) -> str:
    """Fits ``(term, idf)`` over ``docs`` and stores it, sorted by term, for
    ``summarise_stream_extractive``."""
    tfidf_fit(docs, text_col, id_col).sortWithinPartitions("term").write.mode("overwrite").parquet(path)
    return path


def summarise_stream_extractive(spark: SparkSession, source_dir: str, weights_path: str, sink: str, checkpoint: str,
                                min_words: int = 10, max_words: int = 30, files_per_batch: int = 100) -> DataFrame:
    """X-02/R-07: the extractive summary of every new text, by the stored term
    weights; returns the sink, ``(row_id, summary)``.

    Rows that repeat an id within a batch are one row, the one whose text comes
    first. Terms that the stored table doesn't hold weigh nothing. A batch that
    is run again after a failure overwrites its own folder of the sink."""
    src = spark.readStream.schema(TEXT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(source_dir)

    def summarise(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy("row_id").agg(F.min("text").alias("text")).persist()
        try:
            idf = rows.sparkSession.read.parquet(weights_path)
            weights = tfidf_apply(rows, idf, "text")
            out = extractive_summary(rows, "row_id", "text", weights, min_words, max_words)
            out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        finally:
            rows.unpersist()

    q = (src.writeStream.foreachBatch(summarise).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    schema = "row_id long, summary string"
    return spark.read.schema(schema).option("basePath", sink).parquet(f"{sink}/batch=*").select("row_id", "summary")
