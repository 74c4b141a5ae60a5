"""The registered queries of this subpackage: name -> (spark, folder) -> rows.

Each applies one operator, with production parameters, to its whole table and
derives the columns asked for from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (capfilter, contentsort, dartminhash, langid, lm, packing, quality, spans, squares, tokenfile, vectorcodes,
               warc, winnow)
from .common import crc_mod, shared_path, table
from .oracles import ORACLES  # noqa: F401  (for the entry module)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    model = lm.fit(documents.filter(crc_mod("doc_id", 10) != 0), shared_path(spark, "lm"), order=3)
    return lm.score(documents, model).select(
        "doc_id", (crc_mod("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


@query
def op2_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.mark_revisits(table(spark, sf_dir, "pages", "page_id", "url", "html"), "page_id", "html")
    raw, normal = shared_path(spark, "warc-raw"), shared_path(spark, "warc")
    archives = warc.normalise(spark, warc.write(pages, raw), raw, normal)
    return warc.read(spark, normal, archives).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"))


@query
def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), by_words=True)


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = winnow.contaminated_words(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     table(spark, sf_dir, "benchmark", "item_id", "text"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                       F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


@query
def op5_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(documents.filter(~crc_mod("doc_id", 4).isin(2, -1)))
    return langid.predict(documents, model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "cosine", "rejected")


@query
def op6_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilter.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query
def op7_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_50k.json"),
                        shared_path(spark, "packed"), carry=(F.crc32("ids").alias("ids_crc32"),))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(~crc_mod("doc_id", 3).isin(1, -1))
    return quality.score(documents, quality.fit(documents, labels)).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("word_bpe_49k.json"), path)
    return tokenfile.with_crc32(tokenfile.read_tokens(spark, path))


@query
def op11_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vectorcodes.vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    code = F.array_join(F.transform("codes", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """The contract's periodic tails: in a tenth of the documents, every word
    from word a on becomes original word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    told = documents.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, words).alias("_w"))
    n, g = F.size("_w").cast("bigint"), F.floor(F.col("_h") / 10)
    told = told.withColumn("_n", F.when(n > 0, n)).withColumn("_a", (g % F.col("_n")).cast("int"))
    told = told.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))).cast("int"))
    once, left = F.slice("_w", F.col("_a") + 1, F.col("_p")), (F.col("_n") - F.col("_a")).cast("int")
    times = F.ceil(left / F.size(once)).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(once, times)), F.lit(1), left)
    changed = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), tail), " ")
    return told.select("doc_id", F.coalesce(F.when(F.col("_n").isNotNull(), changed), "text").alias("text"))


@query
def op12_dyadic_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = squares.repeated_runs(with_planted_runs(table(spark, sf_dir, "documents", "doc_id", "text")))
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"),
                                                                   (-r["period"]).alias("slow"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", "runs", "collapsed", greatest.alias("top")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.back")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.slow")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.slow")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contentsort.exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
