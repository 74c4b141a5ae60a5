"""Interpolated modified Kneser-Ney n-gram model.

Numbering. A first shuffle counts the words and numbers them, in each shard
the more frequent first. Everything below works on these numbers, so that an
n-gram costs a few bytes on its way and not 8 for each of its words.

Counting. Each task sums its texts' equal n-grams and deals them out, sorted
and packed as a prefix tree; one shuffle per order brings equal n-grams
together. Below the highest order an n-gram's count is the number of different
words before it (its plain count if it starts a text), which falls out of the
order above. What a context needs (its total, and how many words follow it
once, twice or more often) is summed from parts, so no task ever holds all
words that follow a frequent context.

Storage. The model is a folder of arrays, split by hash. An n-gram is 40 bits
of its hash within a bucket that the hash's upper bits choose (about 32
n-grams a bucket, so an n-gram that was never seen is taken for another with a
probability of 3e-11), a byte for its count and a byte for what it needs as a
context; values that a byte can't hold stand in lists of their own. Scoring
tasks map the files into memory, where all workers of a machine share them.

Scoring. p(w | c) = max(a(cw) - D, 0) / total(c) + g(c) p(w | shorter c), with
three discounts D per order from the counts of counts; g(c) is what the
discounts set free. The shortest model is mixed with the uniform distribution
over the known words and one unknown word. A text is its words (lower-cased
A-Z, cut at ASCII white space) and one end token; a begin mark stands before
it as context only.

Defined results: a null or empty text is one end token. Without any training
text every token has probability 1. Rows are scored one by one, so repeated
rows and null ids come out as they went in. Extra columns are ignored.
"""

from __future__ import annotations

import io
import math
import mmap
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of
from .wordhash import Words, mix

_SLICE = 1 << 20
#: More words of a text at once are looked up at less cost.
_SCORED = 2 << 20
#: A byte that says that the value stands in a list of its own.
_LARGE = 255
_END = np.uint64(0x2545F4914F6CDD1D)
_BEGIN = np.uint64(0x9FB21C651E98DF25)
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class NgramModel:
    uri: str
    order: int
    shards: int
    ids: int = 0  # word numbers are below it; the number of unknown words
    vocabulary: int = 0  # distinct training tokens
    tokens: int = 0  # all training tokens
    discounts: list[list[float]] = field(default_factory=list)  # by order from 1, for counts 1, 2, 3+
    types: list[int] = field(default_factory=list)  # of order 1: adjusted total, and types with 1, 2, 3+


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a word run from the hash of all but the last and the last."""
    return mix(left * _STEP + right)


class _Tokens:
    """Token hashes of texts, an end token after each; once numbered, their
    word numbers, and the contexts of each length that a token has."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts)
        sizes = np.diff(words.first)
        self.first = np.r_[0, np.cumsum(sizes + 1)]
        self.token = np.full(self.first[-1], _END)
        is_word = np.ones(self.first[-1], bool)
        is_word[self.first[1:] - 1] = False
        self.token[is_word] = words.hashes()
        #: Tokens before this one in its text.
        self.place = np.arange(len(self.token)) - np.repeat(self.first[:-1], np.diff(self.first))

    def number(self, arrays: _Arrays, model: NgramModel) -> None:
        """From here on ``token`` holds word numbers."""
        words, back = np.unique(np.r_[_BEGIN, self.token], return_inverse=True)
        back = back.astype(np.int64)
        ids = np.full(len(words), model.ids, np.uint64)
        for s, which in _by_shard(_word_shard(words, model.shards)):
            if found := arrays.get(f"v-{s}"):
                have, rank = found[:2]
                at = np.minimum(np.searchsorted(have, words[which]), len(have) - 1)
                hit = have[at] == words[which]
                ids[which[hit]] = rank[at[hit]].astype(np.uint64) * np.uint64(model.shards) + np.uint64(s)
        self.begin, self.token = ids[back[0]], ids[back[1:]]
        #: Different numbers (unknown words' more than once), where in them the begin mark's is, and each token's.
        self.words, self.begin_at, self.token_at = ids, back[0], back[1:]

    def before(self, back: int) -> np.ndarray:
        """The token that many places before each, or the begin mark."""
        out = np.full(len(self.token), self.begin)
        if back < len(out):
            out[back:] = self.token[:-back] if back else self.token
        out[self.place < back] = self.begin
        return out

    def contexts(self, longest: int) -> list[np.ndarray]:
        """[k]: hash of the k tokens before each token; begin marks count as
        one token that stands before the first."""
        return [_hash([self.before(back) for back in range(k, 0, -1)], len(self.token)) for k in range(longest + 1)]


def _hash(columns: list[np.ndarray], n: int) -> np.ndarray:
    h = np.zeros(n, np.uint64)
    for c in columns:
        h = _join(h, c)
    return h


def _by_shard(shard: np.ndarray, gram: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and its rows, in their order, or roughly in that of the
    hashes ``gram``."""
    if gram is None:
        order = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")
    else:
        order = np.argsort((shard << np.uint64(40)) | (gram >> np.uint64(24)))
        # From 16 million shards on, the upper bits don't fit.
        order = order[np.argsort(shard[order], kind="stable")] if len(shard) and shard.max() >> np.uint64(24) else order
    ordered = shard[order]
    new = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(new, np.r_[new[1:], len(order)]):
        yield int(ordered[a]), order[a:b]


def _planes(values: np.ndarray) -> bytes:
    """Numbers at the width that they need, bytes of one significance
    together, which compress better than whole numbers."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    raw = values.astype(f"<u{width}").view(np.uint8).reshape(len(values), width)
    return np.array([width, len(values)], "<i8").tobytes() + raw.T.tobytes()


def _pack(keys: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Different rows in the order of their keys as one compressed blob. A
    prefix of keys that rows share is written once, and what follows it,
    which ascends, as differences."""
    n = len(keys[0])
    out = io.BytesIO()
    out.write(np.array([n, len(keys), len(values)], "<i8").tobytes())
    new, shared = np.zeros(n, bool), np.zeros(n, bool)
    new[:1] = shared[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
        out.write(np.packbits(new).tobytes())
        mine = k[new]
        out.write(_planes(mine - np.where(shared[new], mine.dtype.type(0), np.r_[mine[:0], mine[-1:], mine[:-1]])))
        shared = new.copy()
    for v in values:
        out.write(_planes(v))
    return zstandard.ZstdCompressor(level=3).compress(out.getvalue())


def _unpack(blob: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    data, at = memoryview(zstandard.ZstdDecompressor().decompress(blob)), 24
    n, keys, values = (int(x) for x in np.frombuffer(data[:24], "<i8"))

    def planes() -> np.ndarray:
        nonlocal at
        width, size = (int(x) for x in np.frombuffer(data[at:at + 16], "<i8"))
        raw = np.frombuffer(data[at + 16:at + 16 + width * size], np.uint8).reshape(width, size).T.copy()
        at += 16 + width * size
        return raw.view(f"<u{width}").reshape(size).astype(np.uint64)

    out, shared = [], np.zeros(n, bool)
    shared[:1] = True
    for _ in range(keys):
        new = np.unpackbits(np.frombuffer(data[at:at + -(-n // 8)], np.uint8), count=n).view(bool)
        at += -(-n // 8)
        k = planes()
        total, first = np.cumsum(k, dtype=np.uint64), np.flatnonzero(shared[new])
        total -= np.repeat((total - k)[first], np.diff(np.r_[first, len(k)]))
        out.append(total[np.cumsum(new) - 1])
        shared = new
    return out, [planes() for _ in range(values)]


def _unpacked(blobs: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    parts = [_unpack(b) for b in blobs]
    return tuple([np.concatenate(c) for c in zip(*(p[i] for p in parts))] for i in (0, 1))


def _joined(columns: list[np.ndarray], bits: int) -> np.ndarray:
    out = columns[0].astype(np.uint64)
    for c in columns[1:]:
        out = (out << np.uint64(bits)) | c.astype(np.uint64)
    return out


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where in sorted rows a new one begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _grouped(keys: list[np.ndarray], sums: list[np.ndarray], ids: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows with equal ``keys`` (all at most ``ids``) as one, summed, in the
    order of the keys. As many keys as fit 64 bits are sorted as one number;
    the places in this order and further keys make the next numbers."""
    if not len(keys[0]):
        return [*keys], [*sums]
    bits = int(ids).bit_length()
    done = 64 // bits
    joint = _joined(keys[:done], bits)
    order = np.argsort(joint)
    at = _starts(joint := joint[order])
    while done < len(keys):
        more = max(1, (64 - len(order).bit_length()) // bits)
        run = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(order)]))
        joint = _joined([run, *(k[order] for k in keys[done:done + more])], bits)
        again = np.argsort(joint)
        order, joint = order[again], joint[again]
        at = _starts(joint)
        done += more
    return [k[order[at]] for k in keys], [np.add.reduceat(s[order], at) for s in sums]


def _gram_shard(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    """By context, so that one's words mostly stay together, in some lots, so
    that a frequent context is spread."""
    lots = np.uint64(max(1, math.isqrt(shards)))
    return (mix(context * _STEP + (mix(word) >> np.uint64(32)) % lots) >> np.uint64(32)) % np.uint64(shards)


def _word_shard(word: np.ndarray, shards: int) -> np.ndarray:
    """By the hash's upper bits, so that a shard's hashes lie close together."""
    return ((word >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _shard_of(keys: list[np.ndarray], shards: int) -> np.ndarray:
    keys = [k.astype(np.uint64, copy=False) for k in keys]
    if len(keys) == 1:
        return keys[0] % np.uint64(shards)
    return _gram_shard(_hash(keys[:-1], len(keys[0])), keys[-1], shards)


def _dealt(kind: str, shard: np.ndarray, keys: list[np.ndarray], values: list[np.ndarray]) -> Iterator[tuple[str, int, bytes]]:
    """Blobs by shard; the rows' order within a shard is kept."""
    for s, which in _by_shard(shard):
        yield kind, s, _pack([k[which] for k in keys], [v[which] for v in values])


_DEALT = "kind string, shard int, blob binary"


def _batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    kind, shard, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(shard, pa.int32()),
                                       pa.array(blob, pa.binary())], ["kind", "shard", "blob"])


def _word_task(shards: int, flush: int):
    """Texts to blobs of token hashes and their counts; the begin mark's is 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            (w,), (c,) = _grouped([np.concatenate([h[0] for h in held])], [np.concatenate([h[1] for h in held])], 2**64 - 1)
            return w, c

        for batch in batches:
            texts = texts_of(batch, "_text")
            for at, to in slices(list(map(len, texts)), _SLICE):
                words, counts = np.unique(_Tokens(texts[at:to]).token, return_counts=True)
                held.append((np.r_[_BEGIN, words], np.r_[0, counts].astype(np.uint64)))
                if sum(len(h[0]) for h in held) >= flush:
                    held = [summed()]
                    if len(held[0][0]) >= flush // 2:
                        yield _batch(list(_dealt("v", _word_shard(held[0][0], shards), held[0][:1], held[0][1:])))
                        held = []
        if held:
            w, c = summed()
            yield _batch(list(_dealt("v", _word_shard(w, shards), [w], [c])))
    return run


def _number(uri: str):
    """Blobs of one shard's tokens: summed, numbered and saved."""
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        (words,), (counts,) = _unpacked(group.column("blob").to_pylist())
        (words,), (counts,) = _grouped([words], [counts], 2**64 - 1)
        frequent = np.argsort(counts, kind="stable")[::-1]
        rank = np.empty(len(words), np.uint32)
        rank[frequent] = np.arange(len(words), dtype=np.uint32)
        _save(uri, f"v-{key[0].as_py()}", [words, rank, *_coded(counts[frequent])])
        return pa.table({"ranks": [len(words)], "words": [int((counts > 0).sum())], "tokens": [int(counts.sum())]})
    return run


def _count_task(model: NgramModel, flush: int):
    """Texts to blobs of grams: word numbers and a count."""
    order, shards = model.order, model.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model.uri)
        kind = np.uint32 if model.ids < 1 << 32 else np.uint64
        held: list[list[list[np.ndarray]]] = [[] for _ in range(order + 1)]

        def out(k: int, last: bool):
            columns = [np.concatenate(c) for c in zip(*held[k])]
            held[k] = []
            keys, sums = _grouped(columns[:-1], columns[-1:], model.ids)
            if last or len(keys[0]) >= flush // 2:
                yield _batch(list(_dealt(f"g{k}", _shard_of(keys, shards), keys, sums)))
            else:
                held[k].append([*keys, *sums])

        for batch in batches:
            texts = texts_of(batch, "_text")
            for at, to in slices(list(map(len, texts)), _SLICE):
                t = _Tokens(texts[at:to])
                t.number(arrays, model)
                for k in range(2, order + 1):
                    # Below the highest order only grams that start with the begin mark are counted here.
                    pick = t.place >= k - 2 if k == order else t.place == k - 2
                    held[k].append([*(t.before(back)[pick].astype(kind) for back in range(k - 1, -1, -1)),
                                    np.ones(pick.sum(), np.uint64)])
                    if sum(len(c[0]) for c in held[k]) >= flush:
                        yield from out(k, False)
        for k in range(2, order + 1):
            if held[k]:
                yield from out(k, True)
    return run


def _save(uri: str, name: str, columns: list[np.ndarray]) -> None:
    """Arrays one after the other as raw little-endian numbers."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path, recursive=True)
    own = f"{path}/{name}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(own, compression=None) as f:
        f.write(np.array([len(columns), *(x for c in columns for x in (c.itemsize, len(c)))], "<i8").tobytes())
        for c in columns:
            f.write(np.ascontiguousarray(c).tobytes())
            f.write(bytes(-c.nbytes % 8))
    fs.move(own, f"{path}/{name}")


def _narrow(c: np.ndarray) -> np.ndarray:
    return c.astype("<u4" if not len(c) or c.max() < 1 << 32 else "<u8")


def _coded(counts: np.ndarray) -> list[np.ndarray]:
    """A byte for each count, and the rows and counts that need more."""
    large = np.flatnonzero(counts >= _LARGE)
    return [np.minimum(counts, _LARGE).astype("u1"), _narrow(large), _narrow(counts[large])]


def _coded_contexts(n: int, at: np.ndarray, sums: list[np.ndarray]) -> list[np.ndarray]:
    """A byte for each of ``n`` contexts, of which those ``at`` some rows (in
    order) have total, n1, n2 and n3: 16 n1 + n2 if these are small and n3 is
    0, for then they make up the total; and the others' rows and numbers."""
    total, n1, n2, n3 = sums
    small = (n3 == 0) & (n1 < 16) & (n2 < 16) & (n1 * 16 + n2 < _LARGE)
    byte = np.zeros(n, "u1")
    byte[at] = np.where(small, n1 * 16 + n2, _LARGE)
    return [byte, _narrow(at[~small]), *(_narrow(s[~small]) for s in sums)]


def _decoded(at: np.ndarray, byte: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = byte[at].astype(np.int64)
    large = np.flatnonzero(out == _LARGE)
    out[large] = counts[np.searchsorted(rows, at[large])]
    return out


def _decoded_contexts(d: list[float], at: np.ndarray, byte: np.ndarray, rows: np.ndarray,
                      *sums: np.ndarray) -> list[np.ndarray]:
    """Total and freed share (under the discounts ``d``) of contexts; both 1
    if no word follows."""
    code = byte[at]
    n1, n2 = np.arange(256) >> 4, np.arange(256) & 15
    out = [o[code] for o in _freed(d, n1 + 2 * n2, n1, n2, np.zeros(256, np.int64))]
    large = np.flatnonzero(code == _LARGE)
    where = np.searchsorted(rows, at[large])
    for o, v in zip(out, _freed(d, *(s[where].astype(np.int64) for s in sums))):
        o[large] = v
    return out


def _freed(d: list[float], total: np.ndarray, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray) -> list[np.ndarray]:
    seen = np.maximum(total, 1)
    return [seen, np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / seen, 1.0)]


def _bucketed(gram: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes as the first row of each bucket, which their upper bits
    choose, and their next 40 bits."""
    upper = np.uint64((len(gram) // 32).bit_length())
    bucket = gram >> (np.uint64(63) - upper) >> np.uint64(1)
    first = np.searchsorted(bucket, np.arange((1 << int(upper)) + 1, dtype=np.uint64))
    rest = (gram << upper) >> np.uint64(24)
    return [_narrow(first), (rest >> np.uint64(8)).astype("<u4"), rest.astype("u1")]


def _places(gram: np.ndarray, first: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The row of each hash, -1 where absent."""
    if not len(high):
        return np.full(len(gram), -1)
    upper = np.uint64((len(first) - 1).bit_length() - 1)
    bucket = (gram >> (np.uint64(63) - upper) >> np.uint64(1)).astype(np.int64)
    rest = (gram << upper) >> np.uint64(24)
    high_wanted, low_wanted = (rest >> np.uint64(8)).astype(np.uint32), rest.astype(np.uint8)
    at, end = first[bucket].astype(np.int64), first[bucket + 1].astype(np.int64)
    for bit in range(int((end - at).max(initial=0)).bit_length() - 1, -1, -1):
        probe = at + (1 << bit)
        less = high.take(probe - 1, mode="clip") < high_wanted
        less &= probe <= end
        at += less.astype(np.int64) << bit
    hit = at < end
    hit &= high.take(at, mode="clip") == high_wanted
    left = np.flatnonzero(hit)
    while len(left):
        # Few have the upper bits in common with others.
        left = left[low[at[left]] != low_wanted[left]]
        at[left] += 1
        more = (at[left] < end[left]) & (high.take(at[left], mode="clip") == high_wanted[left])
        hit[left[~more]] = False
        left = left[more]
    return np.where(hit, at, -1)


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == j).sum()) for j in (1, 2, 3, 4)]


def _reduce(model: NgramModel, k: int):
    """Blobs of one shard: grams of order k are summed, saved with what they
    need as contexts, and turned into parts of contexts and of shorter grams;
    other blobs pass."""
    n, uri, shards, ids = model.order, model.uri, model.shards, model.ids

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        blobs: dict[str, list[bytes]] = {}
        for kind, blob in zip(group.column("kind").to_pylist(), group.column("blob").to_pylist()):
            blobs.setdefault(kind, []).append(blob)
        del group
        rows: list[tuple[str, int, bytes]] = []
        grams, contexts = blobs.pop(f"g{k}", []), blobs.pop(f"c{k + 1}", [])
        for kind, some in blobs.items():
            if kind[0] == "s":
                (at,), sums = _grouped(*_unpacked(some), 7)
                rows.append((kind, 0, _pack([at], sums)))
            else:
                rows += [(kind, shard, b) for b in some]
        if not grams and not contexts:
            return pa.Table.from_batches([_batch(rows)])
        keys, (adjusted,) = _grouped(*_unpacked(grams), ids) if grams else ([np.zeros(0, np.uint64)] * k, [np.zeros(0, np.uint64)])
        above = _grouped(*_unpacked(contexts), ids) if contexts else ([np.zeros(0, np.uint64)] * k, [np.zeros(0, np.uint64)] * 4)
        stat = [len(adjusted), int(adjusted.sum()), 0, *_count_of_counts(adjusted)]
        rows.append((f"s{k}", 0, _pack([np.arange(7, dtype=np.uint64)], [np.array(stat, np.uint64)])))
        if k == 1:
            # The begin mark has a number, but is no word: only what it needs as a context is here.
            size = len(_Arrays(uri).get(f"v-{shard}")[0])
            counts = np.zeros(size, np.uint64)
            counts[keys[0] // np.uint64(shards)] = adjusted
            _save(uri, f"g1-{shard}", [*_coded(counts), *_coded_contexts(
                size, (above[0][0] // np.uint64(shards)).astype(np.int64), above[1])])
            return pa.Table.from_batches([_batch(rows)])
        gram = _hash(keys, len(adjusted))
        order = np.argsort(gram)
        gram = gram[order]
        extra = []
        if k < n:
            # Every context is a gram of its length.
            context = _hash(above[0], len(above[0][0]))
            by_hash = np.argsort(context)
            extra = _coded_contexts(len(gram), np.searchsorted(gram, context[by_hash]), [s[by_hash] for s in above[1]])
        _save(uri, f"g{k}-{shard}", [*_bucketed(gram), *_coded(adjusted[order]), *extra])
        del gram, order, extra, above
        # The keys are in order, and so are their prefixes.
        at = _starts(*keys[:-1])
        context = [c[at] for c in keys[:-1]]
        sums = [np.add.reduceat(p.astype(np.uint64), at) for p in (adjusted, adjusted == 1, adjusted == 2, adjusted > 2)]
        rows += _dealt(f"c{k}", _shard_of(context, shards), context, sums)
        del context, sums
        shorter, sums = _grouped(keys[1:], [np.ones(len(adjusted), np.uint64)], ids)
        rows += _dealt(f"g{k - 1}", _shard_of(shorter, shards), shorter, sums)
        return pa.Table.from_batches([_batch(rows)])
    return run


def fit(documents: DataFrame, uri: str, text_col: str = "text", order: int = 2, shard_bytes: int = 16 << 20,
        flush: int = 2_000_000) -> NgramModel:
    """Count the model of ``documents`` into the shared folder ``uri``. One
    shard of each order holds the n-grams of about ``shard_bytes`` of text."""
    texts = documents.select(F.col(text_col).alias("_text"))
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    model = NgramModel(uri, order, max(8, -(-size // shard_bytes)))
    if order < 2:
        raise ValueError("order must be at least 2")
    numbered = texts.mapInArrow(_word_task(model.shards, flush), _DEALT).groupBy("shard") \
        .applyInArrow(_number(uri), "ranks bigint, words bigint, tokens bigint") \
        .agg(F.max("ranks"), F.sum("words"), F.sum("tokens")).first()
    ranks, model.vocabulary, model.tokens = (x or 0 for x in numbered)
    model.ids = ranks * model.shards
    stats = {}
    if model.tokens:
        rows = texts.mapInArrow(_count_task(model, flush), _DEALT)
        for k in range(order, -1, -1):
            rows = rows.groupBy("shard").applyInArrow(_reduce(model, k), _DEALT)
        stats = {r["kind"]: _unpack(bytes(r["blob"]))[1][0] for r in rows.filter("kind like 's%'").collect()}
    for k in range(1, order + 1):
        types, total, _, n1, n2, n3, n4 = (float(x) for x in stats.get(f"s{k}", np.zeros(7)))
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
        # Small counts can put an estimate outside its range.
        model.discounts.append([min(max(d, 0.1 * j), j - 0.1 * j) for j, d in zip((1, 2, 3), raw)])
        if k == 1:
            model.types = [int(total), int(n1), int(n2), int(types) - int(n1) - int(n2)]
    return model


class _Arrays:
    """A shard's arrays, mapped into memory. In a store without local files
    the file is first copied to an unnamed file on the machine's disk."""

    def __init__(self, uri: str):
        self.uri, self.open = uri, {}

    def get(self, name: str) -> list[np.ndarray]:
        """A file's arrays; none if there is no such file."""
        if name not in self.open:
            fs, path = pafs.FileSystem.from_uri(f"{self.uri}/{name}")
            if fs.get_file_info(path).type == pafs.FileType.NotFound:
                self.open[name] = []
                return self.open[name]
            if isinstance(fs, pafs.LocalFileSystem):
                with open(path, "rb") as f:
                    data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            else:
                import shutil
                import tempfile
                with tempfile.TemporaryFile() as f, fs.open_input_stream(path) as source:
                    shutil.copyfileobj(source, f, 1 << 20)
                    f.flush()
                    os.fsync(f.fileno())
                    data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            count = int(np.frombuffer(data, "<i8", 1)[0])
            at, out = 8 + 16 * count, []
            for width, n in np.frombuffer(data, "<i8", 2 * count, 8).reshape(count, 2).tolist():
                out.append(np.frombuffer(data, f"<u{width}", n, at))
                at += width * n + -(width * n) % 8
            self.open[name] = out
        return self.open[name]

    def words(self, ids: np.ndarray, model: NgramModel) -> list[np.ndarray]:
        """Of words their plain and adjusted count, and as contexts their
        total and freed share."""
        out = [np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64), np.ones(len(ids))]
        known = np.flatnonzero(ids < model.ids)
        for s, which in _by_shard(ids[known] % np.uint64(model.shards)):
            which = known[which]
            at = (ids[which] // np.uint64(model.shards)).astype(np.int64)
            out[0][which] = _decoded(at, *self.get(f"v-{s}")[2:])
            if found := self.get(f"g1-{s}"):
                out[1][which] = _decoded(at, *found[:3])
                out[2][which], out[3][which] = _decoded_contexts(model.discounts[1], at, *found[3:])
        return out

    def grams(self, k: int, shard: np.ndarray, gram: np.ndarray, model: NgramModel) -> list[np.ndarray]:
        """Adjusted count of grams (0 where absent) and, below the highest
        order, as contexts their total and freed share. Looked up shard by
        shard."""
        out = [np.zeros(len(gram), np.int64)]
        if k < model.order:
            out += [np.ones(len(gram), np.int64), np.ones(len(gram))]
        for s, which in _by_shard(shard, gram):
            if found := self.get(f"g{k}-{s}"):
                at = _places(gram[which], *found[:3])
                which, at = which[at >= 0], at[at >= 0]
                out[0][which] = _decoded(at, *found[3:6])
                if k < model.order:
                    out[1][which], out[2][which] = _decoded_contexts(model.discounts[k], at, *found[6:])
        return out


def _discount(counts: np.ndarray, discounts: list[float]) -> np.ndarray:
    return np.maximum(counts - np.r_[0.0, discounts][np.minimum(counts, 3)], 0)


def _probabilities(model: NgramModel, arrays: _Arrays, t: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Each token's probability and its plain count in training."""
    t.number(arrays, model)
    plain, adjusted, seen, freed = arrays.words(t.words, model)
    total, *n = model.types
    free = sum(d * x for d, x in zip(model.discounts[0], n)) / total
    p = ((_discount(adjusted, model.discounts[0]) / total) + free / (model.vocabulary + 1))[t.token_at]
    # A token's context is the gram, one shorter, that ends one place before it, begin mark included.
    seen, freed = (np.where(t.place > 0, np.roll(x[t.token_at], 1), x[t.begin_at]) for x in (seen, freed))
    contexts = t.contexts(model.order - 1)
    for k in range(2, model.order + 1):
        # One longer than the text so far is the one before.
        use = np.flatnonzero(t.place >= k - 2) if k > 2 else slice(None)
        context, word = contexts[k - 1][use], t.token[use]
        counts, *found = arrays.grams(k, _gram_shard(context, word, model.shards), _join(context, word), model)
        p[use] = _discount(counts, model.discounts[k - 1]) / seen[use] + freed[use] * p[use]
        for x, f in zip((seen, freed), found):
            x[use] = f
            x[1:] = x[:-1].copy()
    return p, plain[t.token_at]


def score(documents: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text",
          base_weight: float = 0.1) -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score)`` for every row; scores
    are sums of log10 probabilities, base_score's from single tokens' counts
    with ``base_weight`` added to each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model.uri)
        for batch in batches:
            texts = texts_of(batch, "_text")
            for at, to in slices(list(map(len, texts)), _SCORED):
                t = _Tokens(texts[at:to])
                if model.tokens:
                    p, plain = _probabilities(model, arrays, t)
                else:
                    p, plain = np.ones(len(t.token)), np.zeros(len(t.token), np.int64)
                base = np.log10((plain + base_weight) / (model.tokens + base_weight * (model.vocabulary + 1)))
                edge = t.first[:-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(at, to - at), pa.array(np.diff(t.first)),
                     pa.array(np.add.reduceat((plain > 0).astype(np.int64), edge)),
                     pa.array(np.add.reduceat(base, edge)), pa.array(np.add.reduceat(np.log10(p), edge))],
                    ["_id", "n_tokens", "n_known", "base_score", "score"])

    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double") \
        .withColumnRenamed("_id", id_col)
