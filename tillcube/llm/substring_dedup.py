"""Substring dedup by compressed FM-indexes (operator 3).

Documents are cut into routed segments (see ``routing.py``); each shard builds
an FM-index (wavelet matrix over the BWT) of the words sent to it, and all
its segments are streamed backwards through the index in lockstep.  The
matching statistics, held at the threshold ``length``, give at each position
the suffix-array interval of the window that starts there; a window whose
interval holds an earlier place is reported.

A word goes if a window of ``length`` words that covers it also starts
earlier (smaller id, or same document and earlier start).  Null or empty
texts have no words; documents of fewer words lose nothing.  Rows equal in
id and text count as one document; rows with one id and different texts are
ordered by a hash of the text; a null id is smaller than any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .fmindex import FMIndex, suffix_array
from .routing import Spec, flagged, has_ties, keyed, per_chunk, removed_mask, repeated_windows
from .text import spaced, tokenise

WINDOW = 20


def _words(data, off):
    w = tokenise(data, off, spaced)
    return w.hash, w.off


def spec(length: int = WINDOW) -> Spec:
    return Spec(length, max(1, length // 4), _words, np.dtype("<u8"))


def earlier_windows(length: int):
    """Shard function: the windows that also start earlier in the shard."""
    def solve(words: np.ndarray, off: np.ndarray, copies: np.ndarray) -> np.ndarray:
        pieces, n = len(off) - 1, len(words)
        vocabulary, ids = np.unique(words, return_inverse=True)
        at = np.arange(n) + np.repeat(np.arange(pieces), np.diff(off))     # one separator after each piece
        text = np.zeros(n + pieces, np.int64)
        text[at] = ids + 1
        half = 1 << max(0, (length - 1).bit_length() - 1)
        if half > length - 1:
            half = max(1, half // 2)
        sa, ranks = suffix_array(text, half)
        fm = FMIndex(text, len(vocabulary) + 1, sa=sa)
        prev, this = sa[:-1], sa[1:]

        def edges(depth):                           # heads of the groups of suffixes equal in ``depth`` symbols
            same = ranks[this] == ranks[prev]
            if depth > half:
                top = len(text) - 1
                same &= ranks[np.minimum(this + depth - half, top)] == ranks[np.minimum(prev + depth - half, top)]
            return np.flatnonzero(np.concatenate([[True], ~same]))

        whole = edges(length)
        earliest = np.minimum.reduceat(sa, whole)
        cut = edges(max(1, length - 1))
        lens = np.diff(off)
        begin = off[:-1] + np.arange(pieces)
        lo, hi = fm.everything(pieces)
        out = np.zeros(n, bool)
        order = np.argsort(-lens, kind="stable")
        for t in range(int(lens.max(initial=0))):
            on = order[:np.searchsorted(-lens[order], -t, "left")]       # pieces longer than t
            p = begin[on] + lens[on] - 1 - t
            lo[on], hi[on] = fm.extend(text[p], lo[on], hi[on])
            if t + 1 >= length:                    # matching statistic at the threshold: report, then drop the last word
                a = lo[on]
                hit = earliest[np.searchsorted(whole, a, "right") - 1] < p
                out[p[hit] - on[hit]] = True
                g = np.searchsorted(cut, a, "right") - 1
                lo[on] = cut[g]
                hi[on] = np.append(cut, len(text))[g + 1]
        return out
    return solve


def flagged_windows(docs: DataFrame, length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The keyed documents, and those of them with repeated windows."""
    s = spec(length)
    base = keyed(docs, id_col, text_col)
    return base, repeated_windows(flagged(base, s), s, earlier_windows(length))


def digests(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by
    one space) for every row."""
    s = spec(length)
    base, marked = flagged_windows(docs, length)
    schema = pa.schema([("dk", pa.int64()), ("tie", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def digest(with_spans):
        def fn(rows, data, off):
            w = tokenise(data, off, spaced)
            gone = removed_mask(rows, w.off, s, False) if with_spans else np.zeros(len(w.hash), bool)
            raw, o = data.tobytes(), w.off
            sha = []
            lo, hi = w.start.tolist(), w.end.tolist()
            for i in range(rows.num_rows):
                if gone[o[i]:o[i + 1]].any():
                    kept = [raw[lo[k]:hi[k]] for k in (np.flatnonzero(~gone[o[i]:o[i + 1]]) + o[i]).tolist()]
                else:
                    kept = raw[off[i]:off[i + 1]].split()
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            lost = np.concatenate([[0], np.cumsum(gone)])
            return [rows.column(rows.schema.get_field_index("dk")), rows.column(rows.schema.get_field_index("tie")),
                    pa.array(np.diff(o)), pa.array(lost[o[1:]] - lost[o[:-1]]), pa.array(sha)]
        return fn

    ddl = "dk long, tie long, n_words long, n_removed long, kept_sha256 string"
    plain = base.mapInArrow(per_chunk(digest(False), schema), ddl)
    cut = marked.mapInArrow(per_chunk(digest(True), schema), ddl).select(
        "dk", "tie", F.col("n_removed").alias("r"), F.col("kept_sha256").alias("k"))
    return plain.join(cut, ["dk", "tie"], "left").select(
        F.when(F.col("dk") != -(1 << 63), F.col("dk")).alias("doc_id"), "n_words",
        F.coalesce("r", "n_removed").alias("n_removed"), F.coalesce("k", "kept_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all columns) without the repeated words, white space
    between kept words as it was; a document that loses all its words goes."""
    s = spec(length)
    _, marked = flagged_windows(docs, length, id_col, text_col)
    schema = pa.schema([("dk", pa.int64()), ("tie", pa.int64()), ("cleaned", pa.string()), ("left", pa.int64())])

    def clean(rows, data, off):
        w = tokenise(data, off, spaced)
        gone = removed_mask(rows, w.off, s, False)
        out = cut_words(data, off, w, gone)
        lost = np.concatenate([[0], np.cumsum(~gone)])
        return [rows.column(rows.schema.get_field_index("dk")), rows.column(rows.schema.get_field_index("tie")), pa.array(out, pa.string()), pa.array(lost[w.off[1:]] - lost[w.off[:-1]])]

    done = marked.mapInArrow(per_chunk(clean, schema), "dk long, tie long, cleaned string, left long")
    own = keyed(docs, id_col, text_col)
    keys = own.columns[:2]
    unique = not has_ties(own)
    k = [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), F.lit(0).cast("long") if unique else F.xxhash64(text_col)]
    row = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *[x.alias(n) for x, n in zip(k, keys)])
    joined = row.join(done, keys, "left").filter("left IS NULL OR left > 0")
    return joined.select(*[F.coalesce("cleaned", F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def cut_words(data: np.ndarray, off: np.ndarray, w, gone: np.ndarray) -> list[str]:
    """Texts without the words marked ``gone`` (each with the white space after it)."""
    until = np.append(w.start[1:], len(data))
    last = w.off[1:][np.diff(w.off) > 0] - 1
    until[last] = off[1:][np.diff(w.off) > 0]
    d = np.zeros(len(data) + 1, np.int32)
    np.add.at(d, w.start[gone], 1)
    np.add.at(d, until[gone], -1)
    keep = np.cumsum(d[:-1]) == 0
    return [data[a:b][keep[a:b]].tobytes().decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
