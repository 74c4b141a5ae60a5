"""Source/sink round trips and streaming queries: S-01..S-05, X-01, X-02."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import text as T
from ..operators.reconcile import merge_versions, word_count_filter
from ..sources import files as FS
from ..sources.tables import documents, headlines, versions
from ..streaming import live as LV
from . import sqltext as S
from .articles_q import SUMMARIES
from .catalog import register


@register("json_roundtrip", "S-01 S-04 Q-01",
          f"WITH {S.HEADLINES} SELECT 'doc:' || CAST(row_id AS VARCHAR) AS article_link, headline, is_sarcastic, "
          "CAST(NULL AS VARCHAR) AS _corrupt_record FROM h")
def json_roundtrip(spark, sf):
    """Headline table written as JSON lines, read back with the fixed schema."""
    path = FS.scratch_path(spark, "headlines-json")
    h = headlines(spark, sf).select(F.concat(F.lit("doc:"), F.col("row_id").cast("string")).alias("article_link"),
                                    "headline", "is_sarcastic")
    FS.write_json_lines(h, path)
    return FS.read_json_lines(spark, path)


@register("record_scan", "S-02",
          f"WITH {S.HEADLINES} SELECT headline AS text, is_sarcastic AS label FROM h")
def record_scan(spark, sf):
    path = FS.scratch_path(spark, "records-json")
    FS.write_json_lines(headlines(spark, sf).select("headline", "is_sarcastic"), path)
    return FS.read_records(spark, path)


_CSV_SCHEMA = Ty.StructType([Ty.StructField("row_id", Ty.LongType()), Ty.StructField("headline", Ty.StringType()),
                             Ty.StructField("is_sarcastic", Ty.IntegerType()),
                             Ty.StructField("filtered_tokens", Ty.StringType())])


@register("csv_roundtrip", "S-05 T-07",
          f"WITH {S.HEADLINES} SELECT row_id, headline, is_sarcastic, "
          f"CAST(to_json({S.filtered_tokens('headline')}) AS VARCHAR) AS filtered_tokens FROM merged")
def csv_roundtrip(spark, sf):
    """Merged table with its token arrays written as CSV (arrays as JSON
    text), read back with an explicit schema."""
    v1, v2 = versions(spark, sf)
    m = merge_versions(v1, v2).select("row_id", "headline", "is_sarcastic",
                                      T.filtered_tokens("headline").alias("filtered_tokens"))
    path = FS.scratch_path(spark, "merged-csv")
    FS.write_csv(m, path)
    return FS.read_csv(spark, path, _CSV_SCHEMA)


@register("stream_summaries", "X-02 R-01 T-09",
          f"SELECT doc_id AS row_id, {S.lead_sentence('text')} AS summary FROM documents")
def stream_summaries(spark, sf):
    """Documents dropped as JSON files, summarised by a streaming job."""
    src = FS.scratch_path(spark, "stream-src")
    FS.write_json_lines(documents(spark, sf).select(F.col("doc_id").alias("row_id"), "text"), src)
    root = FS.scratch_path(spark, "stream-out")
    out = LV.summarise_stream(spark, src, os.path.join(root, "sink"), os.path.join(root, "ckpt"))
    return out.select("row_id", "summary")


@register("stream_document_summaries", "X-02 R-07 E-01",
          f"WITH {SUMMARIES} SELECT doc_id AS row_id, summary FROM summ")
def stream_document_summaries(spark, sf):
    """Extractive summaries of all long documents by a streaming job that
    joins stored term weights: what ``document_summaries`` gives in batch."""
    long = word_count_filter(documents(spark, sf), "text", 30, keep_long=True)
    src, root = FS.scratch_path(spark, "live-src"), FS.scratch_path(spark, "live-out")
    FS.write_json_lines(long.select(F.col("doc_id").alias("row_id"), "text"), src)
    weights = LV.store_term_weights(long, "text", "doc_id", os.path.join(root, "idf"))
    return LV.summarise_stream_extractive(spark, src, weights, os.path.join(root, "sink"), os.path.join(root, "ckpt"))


@register("stream_scoring", "X-01 L-07")
def stream_scoring(spark, sf):
    """Test rows scored by a streaming job with the pipeline fitted on the
    training rows (rows-only: the scores come from a fitted model)."""
    from ..operators import models as ML
    from .models_q import fit_pipeline, labelled_split
    data = labelled_split(spark, sf)
    model = fit_pipeline(data.filter(F.col("split") == "train"), ML.naive_bayes())
    src = FS.scratch_path(spark, "score-src")
    FS.write_json_lines(data.filter(F.col("split") == "test").select("row_id", F.col("headline").alias("text")), src)
    root = FS.scratch_path(spark, "score-out")
    return LV.score_stream(spark, src, model, os.path.join(root, "sink"), os.path.join(root, "ckpt"),
                           text_col="headline")
