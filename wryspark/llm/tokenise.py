"""Token ids by the tokenizers library, with a cache of words.

The vocabularies used here never build a token across a place where a single
space stands between two other characters, so a text is cut there and each
piece (the space goes with the piece after it) is encoded once per cache. A
text with white space on either side of such a cut is encoded as a whole.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import CACHES

#: Words of Latin-1 letters: composed already, and lower-cased one by one.
_PLAIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = r"[!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*"
#: Such a word and marks after it, which are always pieces of their own for the
#: vocabularies, and the same as the first word of a line, after a line that
#: ends so. The apostrophe and the signs of special tokens are left out.
_WORD = fr"\A(?P<word>{_PLAIN})(?P<marks>{_MARKS})(?:\n(?P<next>{_PLAIN})(?P<more>{_MARKS}))?\z"
#: Characters of a word that is kept.
_LONGEST = 200


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the characters from U+0100 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in own else next(others)) for b in range(256)}


def _gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after the other, and where each begins."""
    to = np.cumsum(size) - size
    return flat[np.repeat(begin - to, size) + np.arange(size.sum())], to


class _Words:
    """Ids of words, with a cache of those that the library was asked for.
    ``older`` holds words of before, which come back when they are asked for
    again."""

    def __init__(self, tokenizer, whole, bound: int):
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bound = bound
        self.whole, self.merge = whole, tokenizer.model.tokenize
        self.bytes = _byte_letters()
        self.lower = whole("A") == whole("a")
        # Is the space before a word part of its first token?
        self.space = self.bytes[32] if whole(" a") != whole("a") else ""
        # The ids of a line break between two words.
        self.line = whole("a\nb")[len(whole("a")):-len(whole("b"))] if self.space else b""

    def _cached(self, keys: list[str], new) -> list[bytes]:
        out = list(map(self.recent.get, keys))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            key = keys[i]
            ids = self.older.get(key)
            out[i] = new(i) if ids is None else ids
            if len(key) <= _LONGEST:
                self.recent[key] = out[i]
        return out

    def letters(self, words: list[str], space: str) -> list[bytes]:
        """A word of plain letters is one piece for the vocabulary's merges,
        in the byte-level alphabet."""
        def new(i: int) -> bytes:
            word = words[i]
            piece = word if word.isascii() else "".join(map(self.bytes.__getitem__, word.encode()))
            return array("I", [t.id for t in self.merge(space + piece)]).tobytes() if word else b""
        # Without its space a word has a key that no plain word has.
        return self._cached(words if space == self.space else ["\n" + w for w in words], new)

    def others(self, words: list[str], space: str) -> list[bytes | None]:
        """Ids of other words; none for words that need their neighbours."""
        def is_cut(word: str) -> bool:
            return bool(word) and not word[0].isspace() and not word[-1].isspace()
        blank = " " if space else ""
        kept = [w for w in words if is_cut(w)]
        found = dict(zip(kept, self._cached([" " + w if space else "\n " + w for w in kept], lambda i: self.whole(blank + kept[i]))))
        return [found.get(w) for w in words]

    def ids(self, words: pa.Array, space: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of different words: all ids, where each word's begin, how many
        there are, and which words have none because they can't be cut out."""
        if len(self.recent) > self.bound:
            self.recent, self.older = {}, self.recent
        pieces, table = [b"", self.line], np.zeros((len(words), 5), np.int64)
        parts = pc.extract_regex(words, _WORD)
        odd = np.flatnonzero(parts.is_null().to_numpy(zero_copy_only=False))
        named = dict(zip(("word", "marks", "next", "more"), parts.flatten()))

        def add(name: str, at: int, ids_of) -> None:
            values = pc.fill_null(named[name], "")
            if self.lower and name in ("word", "next"):
                values = pc.utf8_lower(values)
            coded = values.dictionary_encode()
            table[:, at] = coded.indices.to_numpy() + len(pieces)
            pieces.extend(ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()))

        add("word", 0, lambda w: self.letters(w, space))
        # A line break is a piece of its own, and the next line's first word has no space.
        table[:, 2] = pc.fill_null(pc.not_equal(named["next"], ""), False).to_numpy(zero_copy_only=False)
        add("next", 3, lambda w: self.letters(w, ""))
        for name, at in (("marks", 1), ("more", 4)):
            add(name, at, lambda w: self._cached(["\n\n" + m for m in w], lambda i: self.whole(w[i])))
        uncut = np.zeros(len(words), bool)
        if len(odd):
            found = self.others(words.take(pa.array(odd)).to_pylist(), space)
            uncut[odd] = [x is None for x in found]
            table[odd] = 0
            table[odd, 0] = np.arange(len(odd)) + len(pieces)
            pieces.extend(x or b"" for x in found)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        flat, table = np.frombuffer(b"".join(pieces), "<u4"), table.ravel()
        flat, _ = _gathered(flat, (np.cumsum(size) - size)[table], size[table])
        size = size[table].reshape(-1, 5).sum(1)
        return flat, np.cumsum(size) - size, size, uncut


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids. A call's different
    words are looked up once. ``cache_words`` bounds the cache: when half of it
    is full, its words become the older ones and the older ones go (it may pass
    the bound by one call's words)."""

    def __init__(self, path: str, cache_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer, self.whole, cache_words // 2)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words, edge = cut.flatten(), np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy())]
        later = np.ones(len(words), bool)
        later[edge[:-1]] = False  # a text's first word has no space before it
        first = words.filter(pa.array(~later)).dictionary_encode()
        rest = words.filter(pa.array(later)).dictionary_encode()
        edge -= np.arange(len(edge))
        del cut, words, later
        begins, begins_at, begins_size, no_begin = self.words.ids(first.dictionary, "")
        # The space may be no part of a token; the words then are the same in both places.
        flat, at, size, uncut = self.words.ids(rest.dictionary, self.words.space)
        which = rest.indices.to_numpy()
        bad = np.r_[0, np.cumsum(uncut[which])][edge] if uncut.any() else np.zeros(len(edge), np.int64)
        size = size[which]
        flat, _ = _gathered(flat, at[which], size)
        edge, out = np.r_[0, np.cumsum(size)][edge], []
        for i, (text, f) in enumerate(zip(texts, first.indices.to_pylist())):
            if bad[i + 1] > bad[i] or no_begin[f]:
                out.append(self.whole(text))
            else:
                a = begins_at[f]
                out.append(begins[a:a + begins_size[f]].tobytes() + flat[edge[i]:edge[i + 1]].tobytes())
        return out


_ENCODERS: dict[str, WordEncoder] = {}
CACHES.append(_ENCODERS.clear)


def encoder(path: str) -> WordEncoder:
    """One encoder per vocabulary file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
