"""Near-duplicate vectors by spherical-cap filters.

Filter directions are the words of a random product code: a vector's
coordinates, turned by a random rotation, are cut into blocks, every block has
a small list of random unit vectors, and each choice of one per block is a
direction. Such a code has very many directions, yet list decoding finds all
those that exceed a bound without trying the others: block by block, partial
sums that cannot reach the bound any more are dropped.

Every vector is stored under its best direction and looks into all directions
that come within a slack of it. For two vectors at the threshold t, the best
direction of one is lower than the other's best by a random amount with a
spread of about sqrt(1 - t**2) / sqrt(length); the slack is ``width`` times
that and decides the recall. Of 200,000 random pairs at exactly 0.98 in 64
dimensions none needs a width over 2.8. Pairs that meet are verified with
their cosine in double precision. Equal vectors are one vector with a count.

Directions with very many vectors (groups of near copies) are dealt out as
pairs of blocks; a task compares two blocks and returns, for each vector, how
many links it has and one neighbour towards the smallest vector of its
local group, never the pairs.

Defined results: a vector links with nothing if its label is null, or it is
null, empty or zero, or holds a null or non-finite component, or its id is
null (then its component is null too, and it is kept). Vectors of different
lengths don't link. Rows that repeat an id count as vectors of their own in
the number of links. Ids are whole numbers. Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components

_STEP = 2048


class ProductCode:
    """The directions for vectors of a length; the same wherever it is made."""

    def __init__(self, length: int, per_block: int, blocks: int = 4, seed: int = 11):
        rng = np.random.default_rng([seed, length, per_block])
        self.rotation = np.linalg.qr(rng.standard_normal((length, length)))[0]
        blocks = min(blocks, length)
        self.parts = np.array_split(np.arange(length), blocks)
        self.lists = []
        for part in self.parts:
            c = rng.standard_normal((per_block, len(part)))
            self.lists.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(blocks))
        self.per_block = per_block

    def decode(self, x: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best direction of each row, rows, directions): all directions
        within ``slack`` of the row's best."""
        turned = x @ self.rotation
        scores = [turned[:, p] @ c.T for p, c in zip(self.parts, self.lists)]
        top = [s.max(1) for s in scores]
        best = np.zeros(len(x), np.int64)
        for s in scores:
            best = best * self.per_block + s.argmax(1)
        row, word, total = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
        bound, rest = sum(top) - slack, sum(top)
        for s, t in zip(scores, top):
            rest = rest - t
            sums = total[:, None] + s[row]
            # Rounding must not lose the best direction itself.
            keep, choice = np.nonzero(sums + rest[row][:, None] >= bound[row][:, None] - 1e-9)
            row, word, total = row[keep], word[keep] * self.per_block + choice, sums[keep, choice]
        return best, row, word


_CODES: dict[tuple[int, int], ProductCode] = {}


def code(length: int, per_block: int) -> ProductCode:
    if (length, per_block) not in _CODES:
        _CODES[length, per_block] = ProductCode(length, per_block)
    return _CODES[length, per_block]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _meet(home: dict, look: dict, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, smallest id of the local group) for the linked vectors of
    a block of stored and a block of looking vectors. A pair that also meets
    the other way round counts where the smaller id is stored."""
    x, y = _unit(home["vec"]), _unit(look["vec"])
    ids = np.unique(np.r_[home["id"], look["id"]])
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    at_h, at_l = np.searchsorted(ids, home["id"]), np.searchsorted(ids, look["id"])
    pairs = []
    for lo in range(0, len(x), _STEP):
        i, j = np.nonzero(x[lo:lo + _STEP] @ y.T >= threshold)
        i += lo
        other = home["id"][i] != look["id"][j]
        i, j = i[other], j[other]
        both = np.zeros(len(i), bool)
        larger = np.flatnonzero(home["id"][i] > look["id"][j])
        if len(larger):
            seen, own = home["looks"], look["home"][j[larger]]
            both[larger] = [bool((seen[a][np.searchsorted(seen[a], f, "left"):][:1] == f).any())
                            for a, f in zip(i[larger], own)]
        i, j = i[~both], j[~both]
        np.add.at(links, at_h[i], look["count"][j])
        np.add.at(links, at_l[j], home["count"][i])
        pairs.append(np.c_[at_h[i], at_l[j]])
    pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    while True:
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], label[pairs[:, 1]])
        np.minimum.at(new, pairs[:, 1], label[pairs[:, 0]])
        new = new[new]
        if (new == label).all():
            break
        label = new
    hit = np.flatnonzero(links)
    return ids[hit], links[hit], ids[label[hit]]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98, width: float = 3.5, block_rows: int = 512,
                 broadcast_rows: int = 200_000) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    The crowded directions are counted; up to ``broadcast_rows`` of them are
    broadcast, so that the filed vectors are shuffled once, and more are
    joined by shuffle."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"),
                          F.col(label_col).alias("_label"))
    odd = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    can_link = F.coalesce(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~odd
                          & F.exists("_v", lambda x: x != 0), F.lit(False))
    usable = rows.filter(can_link)
    keyed = usable.select("_id", "_label", "_v", F.xxhash64("_label", "_v").alias("_a"),
                          F.xxhash64(F.lit(1), "_v", "_label").alias("_b"))
    classes = keyed.groupBy("_a", "_b").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_count"),
                                            F.first("_label").alias("_label"), F.first("_v").alias("_v")).checkpoint()
    n = classes.count()
    # As many directions as there are groups of sixteen vectors.
    per_block = max(4, int(np.ceil((n / 16) ** 0.25)))
    # Numbers that came as floats travel as floats.
    single = "float" in dict(vectors.dtypes)[vector_col]

    def groups_of(batch: pa.RecordBatch):
        lists = batch.column("_v")
        sizes = np.diff(lists.offsets.to_numpy())
        for length in np.unique(sizes):
            pick = np.flatnonzero(sizes == length)
            yield int(length), pick, np.stack([lists[int(i)].values.to_numpy() for i in pick])

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, pick, v in groups_of(batch):
                best, _, _ = code(length, per_block).decode(_unit(v), 0.0)
                part = batch.take(pa.array(pick))
                yield pa.RecordBatch.from_arrays([part.column("_label"), pa.array(np.full(len(pick), length, np.int32)),
                                                  pa.array(best)], ["_label", "_length", "_word"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _STEP):
                for length, pick, v in groups_of(batch.slice(lo, _STEP)):
                    part = batch.slice(lo, _STEP).take(pa.array(pick))
                    slack = width * np.sqrt(1 - threshold ** 2) / np.sqrt(length)
                    best, row, word = code(length, per_block).decode(_unit(v), slack)
                    order = np.lexsort((word, row))
                    row, word = row[order], word[order]
                    edge = np.searchsorted(row, np.arange(len(pick) + 1))
                    home = word == best[row]
                    looks = [word[edge[r]:edge[r + 1]].astype("<i8").tobytes() if h else None
                             for r, h in zip(row, home)]
                    raw = [x.tobytes() for x in v.astype("<f4" if single else "<f8")]
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_label").take(at), pa.array(np.full(len(row), length, np.int32)), pa.array(word),
                         part.column("_rep").take(at), part.column("_count").take(at), pa.array(best[row]),
                         pa.array(raw, pa.binary()).take(at), pa.array(looks, pa.binary())],
                        ["_label", "_length", "_word", "_rep", "_count", "_home", "_raw", "_looks"])

    kind = classes.schema["_label"].dataType.simpleString()
    key = ["_label", "_length", "_word"]
    crowded = (classes.select("_label", "_v").mapInArrow(stored, f"_label {kind}, _length int, _word bigint")
               .groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks"))
               .filter("_blocks > 1").checkpoint())
    if crowded.count() <= broadcast_rows:
        crowded = F.broadcast(crowded)
    filed = classes.select("_label", "_v", "_rep", "_count").mapInArrow(
        decoded, f"_label {kind}, _length int, _word bigint, _rep bigint, _count bigint, _home bigint, _raw binary, _looks binary")
    blocks = F.coalesce("_blocks", F.lit(1))
    filed = filed.join(crowded, key, "left").withColumn("_block", F.pmod(F.xxhash64("_rep"), blocks).cast("int"))
    # A stored vector meets every block of looking ones, and the other way
    # round; a vector stored here looks here too.
    meets = F.sequence(F.lit(0), blocks - 1)
    as_stored = F.when(F.col("_looks").isNotNull(), F.transform(meets, lambda j: F.struct(
        F.lit(True).alias("_stored"), F.col("_block").alias("_i"), j.alias("_j"))))
    as_looking = F.transform(meets, lambda i: F.struct(F.lit(False).alias("_stored"), i.alias("_i"), F.col("_block").alias("_j")))
    none = F.array().cast("array<struct<_stored:boolean,_i:int,_j:int>>")
    dealt = filed.withColumn("_m", F.explode(F.concat(F.coalesce(as_stored, none), as_looking))).select(
        F.xxhash64(*key, "_m._i", "_m._j").alias("_g"), F.xxhash64(F.lit(2), "_m._j", "_m._i", *key).alias("_h"),
        "_m._stored", "_rep", "_count", "_home", "_raw", F.when(F.col("_m._stored"), F.col("_looks")).alias("_looks"))
    met = dealt.repartition("_g", "_h").sortWithinPartitions("_g", "_h")

    def side(part: pa.Table, is_stored: bool) -> dict:
        raw = part.column("_raw").to_pylist()
        return {"id": part.column("_rep").to_numpy(), "count": part.column("_count").to_numpy(),
                "home": part.column("_home").to_numpy(),
                "vec": np.stack([np.frombuffer(x, "<f4" if single else "<f8") for x in raw]).astype(float),
                "looks": [np.frombuffer(x, "<i8") for x in part.column("_looks").to_pylist()] if is_stored else None}

    def meet(group: pa.Table):
        is_stored = group.column("_stored").to_numpy()
        if len(group) > 1 and is_stored.any() and not is_stored.all():
            yield _meet(side(group.filter(pa.array(is_stored)), True), side(group.filter(pa.array(~is_stored)), False),
                        threshold)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come one after the other; one may go on in the next batch."""
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            g, h = now.column("_g").to_numpy(), now.column("_h").to_numpy()
            edge = np.r_[0, np.flatnonzero((g[1:] != g[:-1]) | (h[1:] != h[:-1])) + 1]
            found = [x for a, b in zip(edge[:-1], edge[1:]) for x in meet(now.slice(a, b - a))]
            held = now.slice(edge[-1])
            yield answer(found)
        if held is not None:
            yield answer(list(meet(held)))

    def answer(found: list) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_rep", "_links", "_to"])

    linked = met.mapInArrow(link, "_rep bigint, _links bigint, _to bigint").checkpoint()
    joined = components(linked, "_rep", "_to")
    numbers = linked.groupBy("_rep").agg(F.sum("_links").alias("_links"))
    summed = (classes.select("_a", "_b", "_rep", "_count").join(numbers, "_rep", "left")
              .join(joined, F.col("_rep") == F.col("node"), "left")
              .select("_a", "_b", (F.coalesce("_links", F.lit(0)) + F.col("_count") - 1).alias("_links"),
                      F.coalesce("component", "_rep").alias("_component")))
    of = keyed.select("_id", "_a", "_b").join(summed, ["_a", "_b"]).select("_id", "_links", "_component")
    others = rows.filter(~can_link).select("_id", F.lit(0).cast("bigint").alias("_links"),
                                           F.col("_id").alias("_component"))
    return of.unionByName(others).select(
        F.col("_id").alias(id_col), F.col("_links").alias("n_links"), F.col("_component").alias("component_id"),
        (F.col("_id").isNull() | (F.col("_id") == F.col("_component"))).alias("kept"))
