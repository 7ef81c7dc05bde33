"""Exact substring dedup by induced suffix sorting (operator 4).

Documents are cut into routed byte segments (see ``routing.py``); each shard
sorts the suffixes of the bytes sent to it by induced sorting: suffixes are
classified as smaller or larger than their successor, the leftmost-smaller
(LMS) substrings are sorted by inducing and named, the string of names is
sorted recursively, and the whole array is induced from it, bucket by bucket
in linear time.  Permuted longest common prefixes then tell which windows of
``length`` bytes stand at another place too.  Each step handles a whole
bucket at once.  The recursion ends in rank doubling as soon as the names
are too many for a bucket-wise pass to pay.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else.  Null is an empty text.  A row repeated in id and text is a
second place; rows of one id with different texts are documents of their
own; a null id is the smallest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .fmindex import suffix_array
from .routing import Spec, flagged, keyed, per_chunk, removed_mask, repeated_windows
from .text import U, runs_of

LENGTH = 400
MAX_BUCKETS = 2048      # symbols up to which the recursion induces


def _bytes(data, off):
    return data, off


def spec(length: int = LENGTH) -> Spec:
    return Spec(length, max(1, min(64, length // 4 // 8 * 8)), _bytes, np.dtype("u1"), hot=4_000, shard=2_000_000)


def _scatter(buckets, sym, at):
    """Append the positions to the buckets of their symbols, order kept."""
    if not len(at):
        return
    k = sym[at]
    o = np.argsort(k, kind="stable")
    k, at = k[o], at[o]
    cut = np.flatnonzero(k[1:] != k[:-1]) + 1
    for c, part in zip(k[np.append(0, cut)].tolist(), np.split(at, cut)):
        buckets[c].append(part)


def _join(parts):
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.int64)


def _induce(sym, small, seeds, sigma):
    """Suffix order from LMS suffixes: ``seeds`` in order; per bucket first
    the larger type from the left, then the smaller type from the right."""
    key = sym[seeds]
    o = np.argsort(key, kind="stable")
    seeds = seeds[o]
    edge = np.searchsorted(key[o], np.arange(sigma + 1))
    large = [[] for _ in range(sigma)]
    for c in range(sigma):
        cur, done = _join(large[c]), []
        while len(cur):
            done.append(cur)
            j = cur[cur > 0] - 1
            j = j[~small[j]]
            same = sym[j] == c
            _scatter(large, sym, j[~same])
            cur = j[same]
        large[c] = _join(done)
        j = seeds[edge[c]:edge[c + 1]]
        _scatter(large, sym, j[j > 0] - 1)
    less = [[] for _ in range(sigma)]
    out = [None] * sigma
    for c in range(sigma - 1, -1, -1):
        cur, done = _join(less[c]), []
        if c == 0:                                  # separators stand in text order
            done, cur = [seeds[edge[0]:edge[1]][::-1]], cur[:0]
        while len(cur):
            done.append(cur)
            j = cur[cur > 0] - 1
            j = j[small[j]]
            same = sym[j] == c
            _scatter(less, sym, j[~same])
            cur = j[same]
        j = large[c][::-1]
        j = j[j > 0] - 1
        _scatter(less, sym, j[small[j]])
        out[c] = np.concatenate([large[c], _join(done)[::-1]])
    return np.concatenate(out)


def induced_suffix_array(sym: np.ndarray) -> np.ndarray:
    """Suffix array of symbols 0..sigma-1 that end in 0; each 0 is a symbol
    of its own, the smaller the further left, and no two 0 are neighbours."""
    n = len(sym)
    sigma = int(sym.max()) + 1
    step = (sym[1:] > sym[:-1]).astype(np.int8) - (sym[1:] < sym[:-1])
    nxt = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n - 1))
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    small = np.append(np.append(step, np.int8(1))[nxt] > 0, True)          # smaller than its successor
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if len(lms) <= 1:
        return _induce(sym, small, lms, sigma)
    order = _induce(sym, small, lms, sigma)                        # LMS substrings in order
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    end = np.empty(n, np.int32)
    end[lms] = np.append(lms[1:], np.int32(n - 1))                           # a substring ends with the next LMS
    a, b = order[:-1], order[1:]
    la, lb = end[a] - a, end[b] - b
    # a separator is equal to nothing, so a substring that has one is alone
    equal = (la == lb) & (sym[a] == sym[b]) & (sym[end[a]] != 0) & (sym[a] != 0) & (sym[end[a]] == sym[end[b]])
    live, k = np.flatnonzero(equal), 1
    while len(live):
        live = live[k < la[live]]
        off = sym[a[live] + k] != sym[b[live] + k]
        equal[live[off]] = False
        live = live[~off]
        k += 1
    name = np.empty(n, np.int32)
    name[order] = np.concatenate([[0], np.cumsum(~equal)])
    names = name[lms]
    count = int(names.max()) + 1
    if count < len(lms):
        names = np.append(names + 1, 0)
        deeper = induced_suffix_array(names) if count <= MAX_BUCKETS else suffix_array(names)[0]
        order = lms[deeper[1:]]
    return _induce(sym, small, order, sigma)


def permuted_lcp(sym: np.ndarray, sa: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position its common prefix with the suffix before it in the
    array, and that suffix's position.  Only where the symbols before the two
    differ is a comparison needed; elsewhere the value is one less than the
    last.  ``left``: symbols before the next separator."""
    n = len(sym)
    phi = np.empty(n, np.int32)
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    i = np.arange(n, dtype=np.int32)
    before = phi - 1
    reducible = (i > 0) & (before >= 0)
    r = np.flatnonzero(reducible)
    reducible[r] = (sym[r - 1] == sym[before[r]]) & (sym[r - 1] != 0)
    lead = np.flatnonzero(~reducible)
    limit = np.where(phi[lead] >= 0, np.minimum(left[lead], left[phi[lead]]), 0)
    got = np.zeros(len(lead), np.int64)
    eight = np.ndarray((n + 1,), "<u8", np.concatenate([sym, np.zeros(8, np.uint8)]), strides=(1,))
    live = np.flatnonzero(limit > 0)
    while len(live):
        at = lead[live] + got[live]
        x = eight[at] ^ eight[phi[lead[live]] + got[live]]
        low = x & (~x + U(1))
        zeros = np.where(x == 0, 8, np.bitwise_count(low - U(1)).astype(np.int64) >> 3)
        got[live] += zeros
        live = live[(zeros == 8) & (got[live] < limit[live])]
    got = np.minimum(got, limit)
    owner = np.maximum.accumulate(np.where(reducible, np.int32(-1), i))
    value = np.zeros(n, np.int32)
    value[lead] = got
    return np.maximum(value[owner] - (i - owner), 0), phi


def repeated_anywhere(length: int):
    """Shard function: windows that start at two places of the shard, and
    those of pieces that stand for several copies."""
    def solve(data: np.ndarray, off: np.ndarray, copies: np.ndarray) -> np.ndarray:
        pieces, n = len(off) - 1, len(data)
        lens = np.diff(off)
        at = np.arange(n) + np.repeat(np.arange(pieces), lens)
        sym = np.zeros(n + pieces, np.uint8)
        sym[at] = data + 1                          # UTF-8 has no byte 255
        left = np.zeros(n + pieces, np.int32)
        left[at] = np.repeat(off[1:], lens) - np.arange(n)
        lcp, phi = permuted_lcp(sym, induced_suffix_array(sym), left)
        hit = np.zeros(n + pieces, bool)
        i = np.flatnonzero(lcp >= length)
        hit[i] = True
        hit[phi[i]] = True
        hit[at] |= np.repeat(copies > 1, lens) & (left[at] >= length)
        return hit[at]
    return solve


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    s = spec(length)
    base = keyed(docs, "doc_id", "text")
    marked = repeated_windows(flagged(base, s), s, repeated_anywhere(length))
    schema = pa.schema([("dk", pa.int64()), ("tie", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def digest(rows, data, off):
        gone = removed_mask(rows, off, s, True)
        lost, spans, sha = [], [], []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            g = gone[a:b]
            lost.append(int(g.sum()))
            spans.append(len(runs_of(g)[0]))
            sha.append(hashlib.sha256(data[a:b][~g].tobytes()).hexdigest())
        return [rows.column(rows.schema.get_field_index("dk")), rows.column(rows.schema.get_field_index("tie")), pa.array(lost, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)]

    cut = marked.mapInArrow(per_chunk(digest, schema), "dk long, tie long, n_removed long, n_spans long, kept_sha256 string")
    text = F.coalesce("text", F.lit(""))
    plain = base.select("dk", "tie", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(F.encode(text, "UTF-8"), 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return plain.join(cut, ["dk", "tie"], "left").select(
        F.when(F.col("dk") != -(1 << 63), F.col("dk")).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


__all__ = ["digests", "induced_suffix_array", "permuted_lcp", "repeated_anywhere", "spec"]
