"""Longest common subsequences in plain Python, to hold the columns against."""

from __future__ import annotations

import numpy as np


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``
    (one big-integer add/or/and per token of ``b``)."""
    if len(a) == 0 or len(b) == 0:
        return 0
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & masks.get(y, 0)
        v = (v + u) | (v - u)
    return len(a) - bin(v & full).count("1")


def lcs_table(a, b) -> np.ndarray:
    """Lengths of the longest common subsequences of all prefixes. A row is
    the running maximum of the row before, one more after each match."""
    t = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    b = np.asarray(b, dtype=object)
    for i, x in enumerate(a, 1):
        step = t[i - 1].copy()
        step[1:] = np.maximum(step[1:], t[i - 1, :-1] + (b == x))
        t[i] = np.maximum.accumulate(step)
    return t


def lcs_positions(ref, cand) -> set[int]:
    """Positions in ``ref`` on one longest common subsequence with ``cand``;
    where both ways back are as long, a word of ``ref`` is passed over."""
    t = lcs_table(ref, cand)
    i, j, hits = len(ref), len(cand), set()
    while i > 0 and j > 0:
        if ref[i - 1] == cand[j - 1]:
            hits.add(i - 1)
            i, j = i - 1, j - 1
        elif t[i, j - 1] > t[i - 1, j]:
            j -= 1
        else:
            i -= 1
    return hits


def summary_lcs_hits(ref_sents, cand_sents) -> tuple[int, int, int]:
    """Union-LCS hits of ROUGE-Lsum: for each reference sentence, the union
    of its LCS positions with every candidate sentence; hits are capped by
    how often each token occurs on either side. Returns (hits, m, n)."""
    from collections import Counter
    ref_cnt = Counter(t for s in ref_sents for t in s)
    cand_cnt = Counter(t for s in cand_sents for t in s)
    m, n = sum(ref_cnt.values()), sum(cand_cnt.values())
    hits = 0
    for r in ref_sents:
        union = set()
        for c in cand_sents:
            union |= lcs_positions(r, c)
        for pos in sorted(union):
            tok = r[pos]
            if ref_cnt[tok] > 0 and cand_cnt[tok] > 0:
                hits += 1
                ref_cnt[tok] -= 1
                cand_cnt[tok] -= 1
    return hits, m, n
