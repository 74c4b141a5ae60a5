"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are maximal runs of ASCII digits, letters and non-ASCII characters after
lower-casing A-Z. Every k-gram of words is hashed; in each window of w
consecutive k-grams the smallest hash is a fingerprint. Two texts that share
k + w - 1 words in a row share a whole window and so a fingerprint, whatever
surrounds it. With k + w - 1 = ``window`` every shared span of that many words
is found.

Fingerprints of documents are joined with those of the benchmark. Around each
hit the document's windows that hold the k-gram are compared, as words, with
the benchmark's windows, which extends hits to whole spans and drops chance
matches. A benchmark item shorter than ``window`` words is one window of all
its words; its fingerprint is the hash of the whole item, and documents are
searched for runs of just the lengths that occur (fewer than ``window``).

Defined results: null texts and texts without words have no words, no hits and
no items, and such items match nothing. Items with the same id count as one
item with all their windows; items with a null id count for hits and are left
out of the list of ids. Documents are told apart by id and text: rows that
repeat both get the same result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text; null gives none."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.split(low, _GAP)
    # Only the first and the last part can be empty.
    return F.filter(parts, lambda w: w != "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once. A column that a lambda
    refers to would be put in its place and computed for every element."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _runs(array: Column, length: int, make) -> Column:
    """``make`` of every run of ``length`` elements; none if there are fewer."""
    starts = F.when(F.size(array) >= length, F.sequence(F.lit(1), F.size(array) - (length - 1)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: make(F.slice(array, i, length)))


def _grams(words_: Column, k: int) -> Column:
    """Hashes of all k-grams of an array of words."""
    return _let(F.transform(words_, lambda x: F.xxhash64(x)), lambda h: _runs(h, k, F.xxhash64))


def _fingerprints(words_: Column, k: int, w: int) -> Column:
    """The distinct smallest hashes of the windows of ``w`` k-grams; of all
    k-grams if there are fewer, and none if there is none."""
    def smallest(grams: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(grams) - (w - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.array_min(F.slice(grams, i, w)))

    return F.array_compact(F.array_distinct(_let(_grams(words_, k), smallest)))


def _occurrences(own: Column, length: int, size: int) -> Column:
    """(place, words) of the windows that hold a k-gram of the column ``_f``."""
    hit = _let(_grams(own, size), lambda g: F.filter(
        F.transform(g, lambda h, i: F.when(F.array_contains(F.col("_f"), h), i + 1)), lambda p: p.isNotNull()))
    starts = F.array_distinct(F.flatten(F.transform(hit, lambda p: F.filter(
        F.sequence(p - (length - size), p), lambda s: (s >= 1) & (s + (length - 1) <= F.size(own))))))
    return F.transform(starts, lambda s: F.struct(
        s.alias("at"), F.concat_ws(" ", F.slice(own, s, length)).alias("span")))


def _keyed(documents: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    """Rows with 128 bits that stand for id and text."""
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *others)
    return rows.withColumns({"_k1": F.xxhash64("_id", "_text"), "_k2": F.xxhash64(F.lit(3), "_text", "_id")})


def _search(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, window: int, k: int,
            broadcast_rows: int) -> tuple[DataFrame, DataFrame]:
    """Occurrences (_k1, _k2, _len, at, _span) of benchmark windows in
    documents, and the windows of each item (_item, _span).

    The benchmark's distinct fingerprints are counted; up to
    ``broadcast_rows`` of these 8-byte numbers are broadcast, so that the
    documents' fingerprints need no shuffle, and more are joined by shuffle."""
    w = window - k + 1
    bench = (items.select(F.col(item_id).cast("string").alias("_item"), words(F.col(item_text)).alias("_words"))
             .withColumn("_n", F.size("_words")).filter("_n > 0"))
    # The benchmark is read by several branches below.
    bench = bench.checkpoint()
    short = sorted(r[0] for r in bench.filter(F.col("_n") < window).select("_n").distinct().collect())
    spans = bench.select("_item", F.explode(
        F.when(F.col("_n") < window, F.array(F.concat_ws(" ", "_words")))
        .otherwise(_runs(F.col("_words"), window, lambda s: F.concat_ws(" ", s)))).alias("_span")).distinct()
    lengths = [window, *short]

    def seeds(length: int) -> tuple[int, DataFrame]:
        """Gram size and the benchmark's fingerprints for spans of a length."""
        of = bench.filter(F.col("_n") == length) if length < window else bench.filter(F.col("_n") >= window)
        size, win = (length, 1) if length < window else (k, w)
        wanted = of.select(F.explode(_fingerprints(F.col("_words"), size, win)).alias("_f")).distinct()
        return size, F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted

    found = None
    for length in lengths:
        size, wanted = seeds(length)
        marks = _let(words(F.col("_text")), partial(_fingerprints, k=size, w=w if length == window else 1))
        prints = docs.select("_k1", "_k2", F.explode(marks).alias("_f"))
        hits = (prints.join(wanted, "_f").groupBy("_k1", "_k2")
                .agg(F.collect_set("_f").alias("_f")).withColumn("_len", F.lit(length)))
        found = hits if found is None else found.unionByName(hits)
    # Documents with some hit, their words once more, and the places of the hits.
    near = docs.join(found, ["_k1", "_k2"])
    places = None
    for length in lengths:
        around = partial(_occurrences, length=length, size=length if length < window else k)
        one = near.filter(F.col("_len") == length).select(
            "_k1", "_k2", "_len", F.explode(_let(words(F.col("_text")), around)).alias("_o"))
        places = one if places is None else places.unionByName(one)
    places = places.select("_k1", "_k2", "_len", "_o.at", F.col("_o.span").alias("_span"))
    return places.join(spans.select("_span").distinct(), "_span"), spans


def contaminated_words(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5,
                       broadcast_rows: int = 500_000) -> DataFrame:
    """``(id, n_words, n_hit, item_ids)`` for every document row; ``item_ids``
    are the sorted ids, as strings, of the items with occurring windows."""
    docs = _keyed(documents, id_col, text_col)
    matched, spans = _search(docs.select("_k1", "_k2", "_text"), items, item_id, item_text, window, k, broadcast_rows)
    matched = matched.checkpoint()
    hit = matched.groupBy("_k1", "_k2").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + F.col("_len") - 1)))))
        .cast("bigint").alias("n_hit"))
    named = (matched.select("_k1", "_k2", "_span").distinct().join(spans, "_span")
             .groupBy("_k1", "_k2").agg(F.sort_array(F.collect_set("_item")).alias("item_ids")))
    counts = docs.select("_id", "_k1", "_k2", F.size(words(F.col("_text"))).cast("bigint").alias("n_words"))
    return (counts.join(hit.join(named, ["_k1", "_k2"]), ["_k1", "_k2"], "left")
            .select(F.col("_id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def uncontaminated(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5,
                   broadcast_rows: int = 500_000) -> DataFrame:
    """The rows, with all their columns, that hold no window of any item."""
    docs = _keyed(documents, id_col, text_col, F.struct(*documents.columns).alias("_doc"))
    matched, _ = _search(docs.select("_k1", "_k2", "_text"), items, item_id, item_text, window, k, broadcast_rows)
    return docs.join(matched.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_anti").select("_doc.*")
