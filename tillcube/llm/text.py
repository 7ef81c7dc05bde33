"""Vectorised word kernel over Arrow text columns, shared by the operators.

Words are maximal runs of bytes of a class; every class used here keeps all
bytes >= 0x80, so a UTF-8 character never splits.  A word is represented by
a 64-bit hash of its bytes (and its byte span).  Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 256 << 10   # texts handled at once (they fit a core cache); a longer text is its own chunk
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spaced(b: np.ndarray) -> np.ndarray:
    """[^\\x20\\x09-\\x0D]+ : words between white space."""
    return (b != 32) & ((b - np.uint8(9)) > 4)


def alnum(b: np.ndarray) -> np.ndarray:
    """[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of lower-cased text: digits, a-z, all non-ASCII."""
    return (b >= 128) | ((b - np.uint8(48)) < 10) | ((b - np.uint8(97)) < 26)


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return b + ((b - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32)


_TAIL = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 8))], U)
LONG_WORD = 512         # bytes; longer words are hashed one by one


@dataclass
class Words:
    data: np.ndarray     # bytes of the chunk
    text_off: np.ndarray  # byte offsets of the texts (n + 1)
    start: np.ndarray    # byte span of each word
    end: np.ndarray
    off: np.ndarray      # word offsets of the texts (n + 1)
    hash: np.ndarray     # uint64 per word


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null is empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches whose texts hold at most ``limit`` bytes (or one text)."""
    for batch in batches:
        data, off = column_bytes(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            j = min(j, n)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def tokenise(data: np.ndarray, off: np.ndarray, cls=spaced, lower: bool = False) -> Words:
    """Words of the texts ``data[off[i]:off[i+1]]``; they never cross texts.
    ``lower`` lower-cases A-Z first."""
    n = len(data)
    if lower:
        data = lower_ascii(data)
    m = cls(data)
    if not m.any():
        z = np.zeros(0, np.int64)
        return Words(data, off, z, z, np.zeros(len(off), np.int64), np.zeros(0, U))
    before = np.zeros(n, bool)
    before[1:] = m[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = m[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    start = np.flatnonzero(m & ~before)
    end = np.flatnonzero(m & ~after) + 1
    return Words(data, off, start, end, np.searchsorted(start, off).astype(np.int64), hash_spans(data, start, end))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = end - start
    h = left.astype(U) * U(0xA0761D6478BD642F)
    on, at = np.arange(len(start)), start
    for i in np.flatnonzero(left > LONG_WORD):
        h[i] ^= U(int.from_bytes(blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little"))
    if len(on) and int(left.max()) > LONG_WORD:
        on = np.flatnonzero(left <= LONG_WORD)
        at, left = start[on], left[on]
    while len(on):
        v = eight[at]
        short = np.flatnonzero(left < 8)
        v[short] &= _TAIL[left[short]]
        x = (h[on] ^ v) * U(0xD1342543DE82EF95)
        x ^= x >> U(32)
        h[on] = x
        more = np.flatnonzero(left > 8)
        on, at, left = on[more], at[more] + 8, left[more] - 8
    return mix(h)


def grams(sym: np.ndarray, q: int) -> np.ndarray:
    """Hash of every run of ``q`` consecutive symbols (length n - q + 1);
    symbols are 64-bit hashes or bytes."""
    if sym.dtype == np.uint8 and q % 8 == 0 and q > 8:      # eight bytes at once
        if len(sym) < q:
            return np.zeros(0, U)
        return _strided(np.ndarray((len(sym) - 7,), "<u8", np.ascontiguousarray(sym), strides=(1,)) * U(0x9E3779B97F4A7C15), q // 8, 8)
    sym = sym.astype(U, copy=False)
    if q == 1:
        return sym
    if len(sym) < q:
        return np.zeros(0, U)
    h = q // 2 if q % 2 == 0 else q - 1
    g = grams(sym, h)
    t = g if q % 2 == 0 else sym
    m = len(sym) - q + 1
    x = g[:m] * U(0x9FB21C651E98DF25)
    x += t[h:h + m]
    x ^= x >> U(29)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def _strided(x: np.ndarray, k: int, step: int) -> np.ndarray:
    """Hash of x[i], x[i + step], ..., ``k`` of them."""
    if k == 1:
        return mix(x)
    h = k // 2 if k % 2 == 0 else k - 1
    g = _strided(x, h, step)
    t = g if k % 2 == 0 else x
    m = len(x) - (k - 1) * step
    out = g[:m] * U(0x9FB21C651E98DF25)
    out += t[h * step:h * step + m]
    out ^= out >> U(29)
    out *= U(0xD6E8FEB86659FD93)
    out ^= out >> U(32)
    return out


def cover(runs_start: np.ndarray, runs_end: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions 0..n-1 covered by the half-open runs."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, runs_start, 1)
    np.add.at(d, runs_end, -1)
    return np.cumsum(d[:n]) > 0


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open maximal runs of True."""
    d = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)
