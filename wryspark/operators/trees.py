"""Trees over sparse features (L-04, L-05).

A row is kept as its stored entries only, each a feature's number and the bin
of its value: 3 bytes an entry, where MLlib holds one whole number per feature.
Bins are quantiles of all rows' stored values, from one count per (feature,
cell), a cell being a float's leading bits; a stored zero and an absent entry
are one value.

A forest's trees are dealt out to tasks. Each task spools all binned rows into
a file that it maps into memory and grows its trees level by level, with one
pass over the rows a level; only the entries of the features that a row's node
drew go into counts. So a task's memory grows with 13 bytes a row, not with
rows times features, and no histogram is shuffled.

Boosting deals rows out instead: a pass over the rows gives the sums by feature
and bin of the smaller child of each split node, the other's are its parent's
less those, and the driver, which picks the splits, holds features times bins.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
                                     HasSeed)
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLWritable)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bits of a float that a cell leaves out: cells are 3 % wide.
_CELL = 18
#: Entries of a pass that are looked at together.
_CHUNK = 1 << 21
#: Entries of (node, feature) tables: more nodes of a level take more passes.
_TABLE = 1 << 25
#: Entries of rows that are still in open nodes are copied out of the file below this.
_COPIED = 1 << 25


def ordered(values) -> np.ndarray:
    """Whole numbers in the order of the values as 32-bit floats; 0 is 0."""
    bits = (np.asarray(values, np.float32) + np.float32(0)).view(np.int32)
    return bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))


def stored_rows(dataset: DataFrame, features_col: str, label_col: str) -> DataFrame:
    """``(_h, _label, _i, _v)``: hash of the row, label, places and values of
    its entries; written once, equal rows side by side."""
    parts = F.unwrap_udt(F.col(features_col))
    rows = dataset.select(F.col(label_col).cast("int").alias("_label"), parts["values"].cast("array<float>").alias("_v"),
                          F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1)).alias("_i"),
                          F.coalesce(parts["size"], F.size(parts["values"])).alias("_size"))
    rows = rows.withColumn("_h", F.xxhash64("_label", "_i", "_v"))
    return cut_lineage(rows.repartition("_h").sortWithinPartitions("_h"))


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column(batch.schema.get_field_index("_i"))
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    values = batch.column(batch.schema.get_field_index("_v")).flatten().to_numpy(zero_copy_only=False)
    return sizes, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ordered(values)


def _count_cells(batches):
    for batch in batches:
        _, feature, value = _entries(batch)
        keys, n = np.unique((feature << 32) + (value >> _CELL), return_counts=True)
        of = (keys + (1 << 31)) >> 32
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (of, keys - (of << 32), n)], ["feature", "cell", "n"])


def _edge_finder(max_bins: int):
    """Counts by cell, sorted inside each feature, to the feature's edges."""
    most = max_bins - 2

    def found(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = np.asarray(lists.value_lengths(), np.int64)
            cell, n = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            of = np.repeat(np.arange(len(sizes)), sizes)
            before = np.cumsum(n) - n
            first = np.cumsum(sizes) - sizes
            total, below = np.bincount(of, n, len(sizes)), before - np.repeat(before[first], sizes)
            part = np.where(sizes[of] <= most, cell, (below * most / total[of]).astype(np.int64))
            cut = np.flatnonzero((of[1:] == of[:-1]) & (part[1:] != part[:-1]))
            cuts = np.concatenate([(of[cut] << 32) + cell[cut], np.unique(of[cell > 0]) << 32, (np.unique(of[cell < 0]) << 32) - 1])
            cuts = np.unique(cuts)
            of = (cuts + (1 << 31)) >> 32
            edge = (((cuts - (of << 32)) << _CELL) | ((1 << _CELL) - 1)).astype(np.int32)
            ends = np.searchsorted(of, np.arange(len(sizes) + 1))
            blobs = [edge[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["feature", "edges"])
    return found


def bin_edges(rows: DataFrame, dim: int, max_bins: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """``(start, edges)``: the edges of feature j, in the order of ``ordered``,
    are ``edges[start[j]:start[j + 1]]``, ``max_bins - 1`` at most. A value's
    bin is the number of edges below it. Zero has a bin of its own; the others
    are quantiles of a feature's other values, or single cells if they are few.
    The driver gets the edges only."""
    counted = rows.select("_i", "_v").mapInArrow(_count_cells, "feature long, cell long, n long") \
        .groupBy("feature", "cell").agg(F.sum("n").alias("n")).filter("cell <> 0")
    lists = counted.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells"))
    found = dict(tuple(r) for r in lists.mapInArrow(_edge_finder(max_bins), "feature long, edges binary").collect())
    edges = [np.frombuffer(found.get(j, b""), np.int32) for j in range(dim)]
    return np.cumsum([0, *map(len, edges)]), np.concatenate([np.zeros(0, np.int32), *edges])


def _binner(bins, dim: int):
    """Rows to ``(key, label, feature, bin)``. The key tells equal rows apart."""
    kind = np.uint16 if dim <= 1 << 16 else np.uint32

    def binned(batches):
        start, edges = bins.value
        flat = (np.repeat(np.arange(dim), np.diff(start)) << 32) + edges
        last, run = None, 0
        for batch in batches:
            sizes, feature, value = _entries(batch)
            at = (np.searchsorted(flat, (feature << 32) + value) - start[feature]).astype(np.uint8)
            h = batch.column(batch.schema.get_field_index("_h")).to_numpy(zero_copy_only=False)
            if not len(h):
                continue
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            rank = np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))
            if h[0] == last:
                rank[:first[1] if len(first) > 1 else len(h)] += run
            last, run = h[-1], rank[-1] + 1
            ends, feature = np.cumsum(sizes), feature.astype(kind)
            cuts = lambda x: [x[e - s:e].tobytes() for e, s in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_mixed(h.view(np.uint64), rank.astype(np.uint64)).view(np.int64)),
                 batch.column(batch.schema.get_field_index("_label")).cast(pa.int32()),
                 pa.array(cuts(feature), pa.binary()), pa.array(cuts(at), pa.binary())], ["key", "label", "feature", "bin"])
    return binned


def _mixed(a: np.ndarray, b) -> np.ndarray:
    """A 64-bit hash of two numbers (splitmix64's finish)."""
    with np.errstate(over="ignore"):
        x = a + np.uint64(0x9E3779B97F4A7C15) * (b + np.uint64(1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _poisson(uniform: np.ndarray) -> np.ndarray:
    steps, term = [np.exp(-1.0)], np.exp(-1.0)
    for k in range(1, 16):
        term /= k
        steps.append(steps[-1] + term)
    return np.searchsorted(steps, uniform, side="right").astype(np.float64)


class _Spooled:
    """All binned rows of a task: entries in a mapped file without a name, the
    rest in memory."""

    def __init__(self, batches, kind):
        keys, labels, sizes = [], [], []
        with tempfile.TemporaryFile() as f, tempfile.TemporaryFile() as b:
            for batch in batches:
                keys.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
                labels.append(batch.column(1).to_numpy(zero_copy_only=False))
                bins = batch.column(3).to_pylist()
                sizes.append(np.fromiter(map(len, bins), np.int32, len(bins)))
                f.writelines(batch.column(2).to_pylist())
                b.writelines(bins)
            self.key, self.label, self.size = (np.concatenate(x) if x else np.zeros(0, t)
                                               for x, t in ((keys, np.uint64), (labels, np.int32), (sizes, np.int32)))
            f.flush(), b.flush()
            none = not self.size.sum()
            self.feature = np.zeros(0, kind) if none else np.memmap(f, kind, "r")
            self.bin = np.zeros(0, np.uint8) if none else np.memmap(b, np.uint8, "r")


def _drawn(rng: np.random.Generator, nodes: int, dim: int, m: int) -> np.ndarray:
    """``m`` different features for each node, ascending."""
    if m >= dim:
        return np.tile(np.arange(dim), (nodes, 1))
    out = np.sort(rng.integers(0, dim, (nodes, m)), axis=1)
    while True:
        again = np.flatnonzero((out[:, 1:] == out[:, :-1]).any(1))
        if not len(again):
            return out
        rows = out[again]
        twice = np.c_[np.zeros(len(rows), bool), rows[:, 1:] == rows[:, :-1]]
        rows[twice] = rng.integers(0, dim, int(twice.sum()))
        out[again] = np.sort(rows, axis=1)


def _best_splits(keys, weights, bins, k, m, total, feats, zero_bin):
    """Per node the split with the largest Gini gain, from counts by ``((node *
    m + drawn feature) * bins + bin) * k + class``: nodes, features, bins, and
    the counts left of the split. Nodes without a gain have none."""
    cell, back = np.unique(keys // k, return_inverse=True)
    counts = np.zeros((len(cell), k))
    np.add.at(counts, (back, keys % k), weights)
    group = cell // bins
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[:len(group)]
    some = group[first]
    rest = total[some // m] - np.add.reduceat(counts, first, axis=0) if len(first) else np.zeros((0, k))
    # What has no entry is in zero's bin.
    cell = np.r_[cell, some * bins + zero_bin[feats[some // m, some % m]]]
    order = np.argsort(cell, kind="stable")
    cell, counts = cell[order], np.vstack([counts, rest])[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[:len(cell)]
    if not len(first):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros((0, k)),)
    cell, counts = cell[first], np.add.reduceat(counts, first, axis=0)
    group = cell // bins
    node = group // m
    run = np.cumsum(counts, axis=0)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    left = run - np.repeat(run[first] - counts[first], np.diff(np.r_[first, len(group)]), axis=0)
    right = total[node] - left
    n_left, n_right, n = left.sum(1), right.sum(1), total[node].sum(1)
    inside = (n_left > 0.5) & (n_right > 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((left ** 2).sum(1) / n_left + (right ** 2).sum(1) / n_right - (total[node] ** 2).sum(1) / n) / n
    ok = np.flatnonzero(inside & (gain > 1e-12))
    order = ok[np.lexsort((ok, -gain[ok], node[ok]))]
    nodes, at = np.unique(node[order], return_index=True)
    best = order[at]
    return nodes, feats[nodes, group[best] % m], cell[best] % bins, left[best]


def _chunks(size: np.ndarray):
    ends = np.r_[0, np.cumsum(size, dtype=np.int64)]
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _CHUNK, side="right")) - 1)
        yield at, to, ends[at], ends[to]
        at = to


def grow_tree(rows, weight: np.ndarray, classes: int, dim: int, m: int, max_depth: int, bins: int,
              zero_bin: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """``(feature, bin, left, counts)`` by node; a leaf's feature is -1, the
    right child stands behind the left one. Leaves of one parent that predict
    the same are put together, as in MLlib."""
    feature, label, size, weight, entries = rows.feature, rows.label, rows.size, weight, rows.bin
    total = np.bincount(label, weight, classes)[None, :]
    made_f, made_b, made_left, made_counts, level_of = [np.full(1, -1)], [np.zeros(1, int)], [np.full(1, -1)], [total], [np.zeros(1, int)]
    ids, made = np.zeros(1, int), 1
    # A row's open node; those in leaves have none.
    node = np.where(weight > 0, 0, -1).astype(np.int32)
    if (total > 0).sum() <= 1:
        ids = ids[:0]
    f_of, b_of, left_of, counts_of = (np.concatenate(x) for x in (made_f, made_b, made_left, made_counts))
    levels = [np.zeros(1, int)]
    for level in range(max_depth):
        if not len(ids):
            break
        open_rows = node >= 0
        if size is rows.size or open_rows.mean() < 0.6:
            if (kept := int(size[open_rows].sum())) <= _COPIED and kept < 0.8 * max(1, len(feature)):
                stays = [(np.repeat(open_rows[a:b], size[a:b]), p, q) for a, b, p, q in _chunks(size)]
                feature, entries = (np.concatenate([x[p:q][s] for s, p, q in stays] or [x[:0]]) for x in (feature, entries))
                label, size, weight, node = (x[open_rows] for x in (label, size, weight, node))
        feats = _drawn(rng, len(ids), dim, m)
        at_once = max(1, _TABLE // dim)
        parts = []
        for lo in range(0, len(ids), at_once):
            some = feats[lo:lo + at_once]
            none = np.iinfo(np.uint16).max
            slot = np.full((len(some) + 1, dim), none, np.uint16)
            slot[np.arange(len(some))[:, None], some] = np.arange(m, dtype=np.uint16)
            slot = slot.reshape(-1)
            seen = []
            for a, b, p, q in _chunks(size):
                here = node[a:b] - lo
                here = np.where((here >= 0) & (here < len(some)) & (node[a:b] >= 0), here, len(some))
                at = np.repeat(here.astype(np.int32 if len(slot) < 1 << 31 else np.int64) * dim, size[a:b])
                at += feature[p:q]
                drawn = slot[at]
                hit = np.flatnonzero(drawn != none)
                row = np.searchsorted(np.cumsum(size[a:b]), hit, side="right")
                key = ((here[row].astype(np.int64) * m + drawn[hit]) * bins + entries[p:q][hit]) * classes + label[a:b][row]
                key, back = np.unique(key, return_inverse=True)
                seen.append((key, np.bincount(back, weight[a:b][row], len(key))))
            keys, weights = (np.concatenate(x) for x in zip(*seen))
            nodes, best_f, best_b, left = _best_splits(keys, weights, bins, classes, m, total[lo:lo + at_once], some, zero_bin)
            parts.append((nodes + lo, best_f, best_b, left))
        nodes, best_f, best_b, left = (np.concatenate(x) for x in zip(*parts))
        if not len(nodes):
            break
        right = total[nodes] - left
        f_of[ids[nodes]], b_of[ids[nodes]], left_of[ids[nodes]] = best_f, best_b, made + 2 * np.arange(len(nodes))
        children = np.stack([left, right], 1).reshape(-1, classes)
        new = made + np.arange(2 * len(nodes))
        made += 2 * len(nodes)
        f_of, left_of = (np.r_[x, np.full(len(new), -1)] for x in (f_of, left_of))
        b_of, counts_of = np.r_[b_of, np.zeros(len(new), int)], np.vstack([counts_of, children])
        levels.append(new)
        is_open = (children > 0.5).sum(1) > 1
        if level + 1 == max_depth:
            break
        place = np.where(is_open, np.cumsum(is_open) - 1, -1).astype(np.int32)
        # What rows of a node do: the split's feature and bin, where absent entries go, and the children's places.
        asks, bound = np.full(len(ids) + 1, dim), np.zeros(len(ids) + 1, int)
        to_left, to_right, absent = np.full(len(ids) + 1, -1, np.int32), np.full(len(ids) + 1, -1, np.int32), np.zeros(len(ids) + 1, bool)
        asks[nodes], bound[nodes], to_left[nodes], to_right[nodes], absent[nodes] = best_f, best_b, place[::2], place[1::2], zero_bin[best_f] <= best_b
        for a, b, p, q in _chunks(size):
            here = node[a:b]
            goes_left = absent[here]
            hit = np.flatnonzero(np.repeat(asks[here].astype(np.uint32), size[a:b]) == feature[p:q])
            row = np.searchsorted(np.cumsum(size[a:b]), hit, side="right")
            goes_left[row] = entries[p:q][hit] <= bound[here[row]]
            node[a:b] = np.where(goes_left, to_left[here], to_right[here])
        ids, total = new[is_open], children[is_open]
    return _pruned(f_of, b_of, left_of, counts_of, levels)


def _pruned(f_of, b_of, left_of, counts_of, levels):
    guess = counts_of.argmax(1)
    for some in reversed(levels):
        inner = some[f_of[some] >= 0]
        a = left_of[inner]
        f_of[inner[(f_of[a] < 0) & (f_of[a + 1] < 0) & (guess[a] == guess[a + 1])]] = -1
    kept = np.zeros(len(f_of), bool)
    kept[0] = True
    for some in levels:
        inner = some[kept[some] & (f_of[some] >= 0)]
        kept[left_of[inner]] = kept[left_of[inner] + 1] = True
    number = np.cumsum(kept) - 1
    left_of = np.where(f_of >= 0, number[left_of], -1)
    return tuple(x[kept] for x in (f_of, b_of, left_of, counts_of))


def _tree_grower(bins, trees: dict, classes: int, dim: int, m: int, max_depth: int, seed: int, max_bins: int):
    def grow(batches):
        groups = []

        def told():
            # A task that got several groups has all rows several times.
            for batch in batches:
                of = batch.column(4)
                groups.extend(g for g in of.unique().to_pylist() if g not in groups)
                yield batch.filter(pc.equal(of, groups[0])) if len(groups) > 1 else batch
        spooled = _Spooled(told(), np.uint16 if dim <= 1 << 16 else np.uint32)
        start, edges = bins.value
        zero_bin = np.array([np.searchsorted(edges[a:b], 0) for a, b in zip(start[:-1], start[1:])])
        for tree in [t for g in groups for t in trees[g]]:
            drawn = _mixed(spooled.key, np.uint64(seed * 1_000_003 + tree)) >> np.uint64(11)
            weight = _poisson(drawn * 2.0 ** -53)
            f, b, left, counts = grow_tree(spooled, weight, classes, dim, m, max_depth, max_bins, zero_bin, np.random.default_rng([seed, tree]))
            edge = np.where(f >= 0, edges[np.minimum(start[np.maximum(f, 0)] + b, max(len(edges) - 1, 0))] if len(edges) else 0, 0)
            share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
            blobs = [x.astype(t).tobytes() for x, t in ((f, np.int32), (edge, np.int32), (left, np.int32), (share, np.float32))]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *[pa.array([x], pa.binary()) for x in blobs]],
                                             ["tree", "feature", "edge", "left", "share"])
    return grow


def _apart(spark, groups: int) -> list[int]:
    """Numbers that a hash partitioning into ``groups`` sends to different tasks."""
    k = spark.range(0, 100 * groups).select(F.col("id").cast("int").alias("g"))
    return [r.g for r in k.groupBy(F.pmod(F.hash("g"), F.lit(groups)).alias("p")).agg(F.min("g").alias("g")).collect()]


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most 256", TypeConverters.toInt)


class SparseRandomForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Random forest with MLlib's method on all rows: Poisson(1) bootstrap, the
    root of the features drawn for each node, Gini, binned thresholds, no
    pruning but of equal leaves. The same rows and seed give the same forest,
    however they are partitioned. Labels are 0, 1, ...; a null fails."""

    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 numTrees=100, maxDepth=30, maxBins=32, seed=42):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, probabilityCol=probabilityCol,
                  numTrees=numTrees, maxDepth=maxDepth, maxBins=maxBins, seed=seed)

    def _fit(self, dataset):
        spark = dataset.sparkSession
        rows = stored_rows(dataset, self.getFeaturesCol(), self.getLabelCol())
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("_size").alias("dim"), F.max("_label").alias("top"),
                        F.min("_label").alias("low"), F.count("_label").alias("labelled")).first()
        if not seen["n"] or seen["labelled"] < seen["n"] or seen["low"] < 0:
            raise ValueError("a forest needs rows whose labels are 0, 1, ...")
        dim, classes, max_bins = seen["dim"], max(2, seen["top"] + 1), self.getOrDefault("maxBins")
        bins = spark.sparkContext.broadcast(bin_edges(rows, dim, max_bins))
        binned = rows.mapInArrow(_binner(bins, dim), "key long, label int, feature binary, bin binary")
        trees = self.getOrDefault("numTrees")
        groups = _apart(spark, min(trees, max(1, spark.sparkContext.defaultParallelism)))
        dealt = {g: list(range(k, trees, len(groups))) for k, g in enumerate(groups)}
        m = max(1, int(np.ceil(np.sqrt(dim))))
        grower = _tree_grower(bins, dealt, classes, dim, m, self.getOrDefault("maxDepth"), self.getSeed(), max_bins)
        grown = binned.withColumn("group", F.explode(F.array(*[F.lit(g) for g in groups]))).repartition(len(groups), "group") \
            .mapInArrow(grower, "tree int, feature binary, edge binary, left binary, share binary")
        model = SparseForestModel()
        model._set(**{p.name: self.getOrDefault(p) for p in (self.featuresCol, self.labelCol, self.predictionCol, self.probabilityCol,
                                                             self.numTrees, self.maxDepth, self.maxBins, self.seed)})
        model.trees = sorted(tuple(r) for r in grown.collect())
        return model


class SparseForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """The grown trees, 16 bytes a node for two classes. The driver holds them;
    scoring tasks get them by broadcast."""

    def __init__(self):
        super().__init__()
        self.trees = []

    def _transform(self, dataset):
        told = dataset.sparkSession.sparkContext.broadcast(self.trees)

        @F.arrow_udf("array<double>")
        def shares(indices: pa.Array, values: pa.Array) -> pa.Array:
            return _scored(told.value, indices, values)

        parts = F.unwrap_udt(F.col(self.getFeaturesCol()))
        places = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
        out = dataset.withColumn("_shares", shares(places, parts["values"]))
        top = F.array_position("_shares", F.array_max("_shares")) - 1
        whole = F.transform("_shares", lambda x: x * len(self.trees))
        return out.withColumn(self.getRawPredictionCol(), array_to_vector(whole)).withColumn(self.getProbabilityCol(), array_to_vector("_shares")) \
            .withColumn(self.getPredictionCol(), top.cast("double")).drop("_shares")

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader(cls)


_TREES = "tree int, feature binary, edge binary, left binary, share binary"


class _ForestWriter(DefaultParamsWriter):
    def saveImpl(self, path):
        super().saveImpl(path)
        self.sparkSession.createDataFrame(self.instance.trees, _TREES).write.parquet(f"{path}/trees")


class _ForestReader(DefaultParamsReader):
    def load(self, path):
        model = super().load(path)
        model.trees = sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                             for r in self.sparkSession.read.parquet(f"{path}/trees").collect())
        return model


#: Rows scored at once: a dense table of them is made.
_SCORED_ROWS = 200
_FORESTS: dict[int, tuple] = {}


def _forest(trees: list) -> tuple:
    """The trees behind one another, kept while a worker scores with them."""
    if id(trees) not in _FORESTS:
        _FORESTS.clear()
        feature, edge, left = ([np.frombuffer(t[c], np.int32) for t in trees] for c in (1, 2, 3))
        roots = np.cumsum([0, *map(len, feature)])[:-1]
        share = [np.frombuffer(t[4], np.float32).reshape(len(f), -1) for t, f in zip(trees, feature)]
        lefts = np.concatenate([x + r for x, r in zip(left, roots)])
        _FORESTS[id(trees)] = trees, roots, np.concatenate(feature), np.concatenate(edge), lefts, np.vstack(share)
    return _FORESTS[id(trees)][1:]


def _scored(trees: list, indices: pa.Array, values: pa.Array) -> pa.Array:
    roots, feature, edge, left, share = _forest(trees)
    dim, classes = int(feature.max(initial=0)) + 1, share.shape[1]
    sizes = np.asarray(indices.value_lengths().fill_null(0), np.int64)
    places, value = indices.flatten().to_numpy(zero_copy_only=False), ordered(values.flatten().to_numpy(zero_copy_only=False))
    ends = np.r_[0, np.cumsum(sizes)]
    out = np.empty((len(sizes), classes))
    for lo in range(0, len(sizes), _SCORED_ROWS):
        hi = min(lo + _SCORED_ROWS, len(sizes))
        i, v = places[ends[lo]:ends[hi]], value[ends[lo]:ends[hi]]
        row = np.repeat(np.arange(hi - lo), sizes[lo:hi])
        table = np.zeros((hi - lo, dim), np.int32)
        asked = i < dim
        table[row[asked], i[asked]] = v[asked]
        at = np.tile(roots, (hi - lo, 1))
        rows = np.arange(hi - lo)[:, None]
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            goes_right = table[rows, np.maximum(f, 0)] > edge[at]
            at = np.where(inner, left[at] + goes_right, at)
        out[lo:hi] = share[at].mean(axis=1, dtype=np.float64)
    offsets = np.arange(0, out.size + 1, classes, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.reshape(-1)))


#: Rows of a block, the unit in which boosting reads them.
_BLOCK_ROWS = 2000
#: Tasks of a boosting pass at most: the driver adds up a histogram of each.
_PASS_TASKS = 48


def _packer(bins, dim: int):
    """Rows to blocks: signs of the labels, scores so far, and the entries."""
    binned = _binner(bins, dim)

    def packed(batches):
        for batch in binned(batches):
            for lo in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(lo, _BLOCK_ROWS)
                sign = 2.0 * part.column(1).to_numpy(zero_copy_only=False) - 1
                entries = part.column(3).to_pylist()
                sizes = np.fromiter(map(len, entries), np.int32, len(entries))
                blobs = sign.astype(np.int8).tobytes(), np.zeros(len(sign)).tobytes(), sizes.tobytes(), b"".join(part.column(2).to_pylist()), b"".join(entries)
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blobs], list(_BLOCK))
    return packed


_BLOCK = ("sign", "score", "size", "feature", "bin")
_BLOCK_SCHEMA = ", ".join(f"{c} binary" for c in _BLOCK)


def _blocks(batches, dim: int):
    kinds = (np.int8, np.float64, np.int32, np.uint16 if dim <= 1 << 16 else np.uint32, np.uint8)
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in enumerate(kinds))


def _places(trees: list, size, feature, values, absent: np.ndarray, dim: int) -> np.ndarray:
    """The node of each tree that each row ends in. A tree is ``(feature, cut)``
    by node, its children at ``2k + 1`` and ``2k + 2``; -1 has none."""
    out = np.zeros((len(size), len(trees)), np.int64)
    wanted = np.unique(np.concatenate([np.asarray(f) for f, *_ in trees])) if trees else np.zeros(0, int)
    wanted = wanted[wanted >= 0]
    column = np.full(dim, -1)
    column[wanted] = np.arange(len(wanted))
    at = column[feature]
    hit = np.flatnonzero(at >= 0)
    table = np.tile(absent[wanted], (len(size), 1))
    table[np.searchsorted(np.cumsum(size), hit, side="right"), at[hit]] = values[hit]
    for t, (f, cut, *_) in enumerate(trees):
        f, cut, place = np.asarray(f), np.asarray(cut), out[:, t]
        while (inner := np.flatnonzero(f[place] >= 0)).size:
            here = place[inner]
            place[inner] = 2 * here + 1 + (table[inner, column[f[here]]] > cut[here])
    return out


def _score(trees: list, places: np.ndarray) -> np.ndarray:
    return sum((w * np.asarray(value)[places[:, t]] for t, (_, _, value, w) in enumerate(trees)), np.zeros(len(places)))


def _summer(trees: list, grown: tuple, asked: list[int], dim: int, bins: int, absent: np.ndarray, first: bool, counted: bool):
    """Counts and sums of the residuals by asked node, feature and bin: the cells
    that have rows, or without ``counted`` the sums of all cells."""
    def summed(batches):
        k = len(asked)
        rows_n, rows_s = np.zeros(k + 1), np.zeros(k + 1)
        count, total = np.zeros((k + 1) * dim * bins, np.int64), np.zeros((k + 1) * dim * bins)
        slot = np.full(max(asked) + 2, k)
        slot[asked] = np.arange(k)
        for sign, score, size, feature, values in _blocks(batches, dim):
            places = _places([*trees, grown], size, feature, values, absent, dim)
            score = score + _score(trees, places)
            rest = sign.astype(float) if first else 4 * sign / (1 + np.exp(2 * sign * score))
            of = slot[np.minimum(places[:, -1], len(slot) - 1)]
            rows_n += np.bincount(of, minlength=k + 1)
            rows_s += np.bincount(of, rest, k + 1)
            inside = np.repeat(of < k, size)
            key = (np.repeat(of, size)[inside] * dim + feature[inside]) * bins + values[inside]
            count += np.bincount(key, minlength=len(count))
            total += np.bincount(key, np.repeat(rest, size)[inside], len(total))
        some = k * dim * bins
        # The root's counts are the same in every round.
        cells = np.flatnonzero(count[:some])
        at, count = ((cells.astype(np.int64), count[cells].astype(np.int32)) if counted else (cells[:0], count[:0]))
        total = total[cells] if counted else total[:some]
        blobs = rows_n[:k].tobytes(), rows_s[:k].tobytes(), at.tobytes(), count.tobytes(), total.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blobs], ["n", "s", "at", "count", "total"])
    return summed


def _scorer(trees: list, dim: int, absent: np.ndarray):
    def scored(batches):
        for block in _blocks(batches, dim):
            sign, score, size, feature, values = block
            new = score + _score(trees, _places(trees, size, feature, values, absent, dim))
            blobs = [sign, new, size, feature, values]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in blobs], list(_BLOCK))
    return scored


def _best_cut(n: float, s: float, count: np.ndarray, total: np.ndarray, absent: np.ndarray):
    """``(feature, bin, n left, s left)`` with the largest fall in variance, or None."""
    count, total = count.astype(float), total.copy()
    at = np.arange(len(count)), absent
    count[at] += n - count.sum(1)
    total[at] += s - total.sum(1)
    n_left, s_left = np.cumsum(count, axis=1), np.cumsum(total, axis=1)
    inside = (n_left > 0.5) & (n_left < n - 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(inside, s_left ** 2 / n_left + (s - s_left) ** 2 / (n - n_left) - s * s / n, -1.0)
    # Rounded, so that equal gains tie whatever the order of a sum: the first feature and bin win.
    gain = np.round(gain / max(n, 1), 12)
    best = int(gain.argmax())
    if gain.size == 0 or gain.flat[best] <= 0:
        return None
    f, b = divmod(best, gain.shape[1])
    return f, b, n_left[f, b], s_left[f, b]


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "weight of a tree after the first", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most 256", TypeConverters.toInt)
    checkpointInterval = Param(Params._dummy(), "checkpointInterval", "trees after which scores are written", TypeConverters.toInt)
    trees = Param(Params._dummy(), "trees", "features, edges and values by node, and weights")


class SparseBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting with MLlib's method on all rows: logistic loss, labels
    0 and 1, regression trees on all features, the first tree on the labels."""

    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 rawPredictionCol="rawPrediction", maxIter=100, stepSize=0.1, maxDepth=3, maxBins=32, checkpointInterval=10):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, probabilityCol=probabilityCol,
                  rawPredictionCol=rawPredictionCol, maxIter=maxIter, stepSize=stepSize, maxDepth=maxDepth, maxBins=maxBins,
                  checkpointInterval=checkpointInterval)

    def _fit(self, dataset):
        sc = dataset.sparkSession.sparkContext
        rows = stored_rows(dataset, self.getFeaturesCol(), self.getLabelCol())
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("_size").alias("dim"), F.max("_label").alias("top"),
                        F.min("_label").alias("low"), F.count("_label").alias("labelled")).first()
        if not seen["n"] or seen["labelled"] < seen["n"] or seen["low"] < 0 or seen["top"] > 1:
            raise ValueError("boosting needs rows whose labels are 0 and 1")
        dim, max_bins = seen["dim"], self.getOrDefault("maxBins")
        start, edges = bin_edges(rows, dim, max_bins)
        absent = np.array([np.searchsorted(edges[a:b], 0) for a, b in zip(start[:-1], start[1:])], np.uint8)
        blocks = rows.mapInArrow(_packer(sc.broadcast((start, edges)), dim), _BLOCK_SCHEMA)
        blocks = cut_lineage(blocks.repartition(min(_PASS_TASKS, max(1, sc.defaultParallelism))))
        every, trees, done, roots = self.getOrDefault("checkpointInterval"), [], 0, []
        for t in range(self.getOrDefault("maxIter")):
            tree = self._grown(blocks, trees[done:], dim, max_bins, absent, t == 0, roots)
            trees.append((*tree, 1.0 if t == 0 else self.getOrDefault("stepSize")))
            if len(trees) - done >= every:
                blocks, done = cut_lineage(blocks.mapInArrow(_scorer(trees[done:], dim, absent), _BLOCK_SCHEMA)), len(trees)
                # The blocks before go from the checkpoint folder once the JVM has collected them.
                sc._jvm.System.gc()
        model = SparseBoostingModel()
        model._set(**{p.name: self.getOrDefault(p) for p in self.params if p.name != "trees"})
        edge = lambda f, b: [int(edges[start[j] + c]) if j >= 0 else 0 for j, c in zip(f, b)]
        model._set(trees=[[list(map(int, f)), edge(f, b), list(map(float, v)), w] for f, b, v, w in trees])
        return model

    def _grown(self, blocks, trees, dim, bins, absent, first, roots):
        depth = self.getOrDefault("maxDepth")
        nodes = 2 ** (depth + 1) - 1
        f, cut, value = np.full(nodes, -1), np.zeros(nodes, int), np.zeros(nodes)
        sums: dict[int, tuple] = {}
        level, asked = [0], [0]
        for _ in range(depth):
            if not asked:
                break
            counted = first or asked != [0]
            told = blocks.mapInArrow(_summer(trees, (f, cut), asked, dim, bins, absent, first, counted),
                                     "n binary, s binary, at binary, count binary, total binary").collect()
            n, s = (sum(np.frombuffer(r[c], float) for r in told) for c in ("n", "s"))
            count, total = np.zeros(len(asked) * dim * bins, np.int64), np.zeros(len(asked) * dim * bins)
            for r in told:
                at = np.frombuffer(r["at"], np.int64) if counted else slice(None)
                total[at] += np.frombuffer(r["total"], float)
                if counted:
                    count[at] += np.frombuffer(r["count"], np.int32)
            if asked == [0]:
                roots.append(count) if first else None
                count, value[0] = roots[0], s[0] / n[0]
            for k, *own in zip(asked, n, s, count.reshape(len(asked), dim, bins), total.reshape(len(asked), dim, bins)):
                sums[k] = tuple(own)
                if k:
                    sums[k + 1 if k % 2 else k - 1] = tuple(a - b for a, b in zip(sums.pop((k - 1) // 2), own))
            following, asked = [], []
            for k in level:
                if best := _best_cut(*sums[k], absent):
                    f[k], cut[k], n_left, s_left = best
                    n_right = sums[k][0] - n_left
                    value[2 * k + 1], value[2 * k + 2] = s_left / n_left, (sums[k][1] - s_left) / n_right
                    following += [2 * k + 1, 2 * k + 2]
                    # A right child's sums are its parent's without the left child's, and the other way round.
                    asked.append(2 * k + 1 if n_left <= n_right else 2 * k + 2)
            level = following
        return f, cut, value


class SparseBoostingModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset):
        trees = self.getOrDefault("trees")

        @F.arrow_udf("double")
        def margin(indices: pa.Array, values: pa.Array) -> pa.Array:
            sizes = np.asarray(indices.value_lengths().fill_null(0), np.int64)
            i = indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            v = ordered(values.flatten().to_numpy(zero_copy_only=False))
            dim = max([0, *(j for t in trees for j in t[0]), i.max(initial=0)]) + 1
            return pa.array(_score(trees, _places(trees, sizes, i, v, np.zeros(dim, np.int32), dim)))

        parts = F.unwrap_udt(F.col(self.getFeaturesCol()))
        places = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
        out = dataset.withColumn("_margin", margin(places, parts["values"]))
        p = 1 / (1 + F.exp(-2 * F.col("_margin")))
        return out.withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-F.col("_margin"), F.col("_margin")))) \
            .withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - p, p))) \
            .withColumn(self.getPredictionCol(), (F.col("_margin") > 0).cast("double")).drop("_margin")
