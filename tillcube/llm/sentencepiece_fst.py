"""SentencePiece encoding and decoding by weighted transducers (operator 5).

The model file is compiled once: the normaliser (dummy prefix, space to
U+2581), the arcs of the pieces, the byte fallback of characters without a
piece, and the weights.  A text is composed with it and the tropical
shortest path is read off:

* unigram models: an arc weighs minus the log probability of its piece;
* merge-ranked models: a segmentation is the model's own exactly if each two
  neighbours are (merging the two alone gives them back), so a state keeps
  the last piece and an arc weighs 0 to a compatible neighbour, infinity
  otherwise.  One path is left; every prefix has one last piece, so the
  composed machine has one live state a position.

No piece goes on with U+2581 after another character (checked), so the
composition splits into words there; the path of a word is kept for its next
occurrence.  Decoding joins the pieces' bytes and undoes the normaliser.
Null and empty texts have no ids and decode to ''.  A text that holds U+2581
itself decodes with a space there, as the model defines.
"""

from __future__ import annotations

import re
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from .files import once

SPACE = "▁"
CACHE = 300_000         # paths and neighbour weights kept in a task


class Transducer:
    """Compiled model; ``encode`` gives ids as little-endian int32 bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with a character map, white space removal or suffix spaces are not supported")
        if proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("unigram or merge-ranked models only")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.unigram = proto.trainer_spec.model_type == 1
        kinds = pb.ModelProto.SentencePiece
        self.weight, self.id, self.bytes_of, self.byte_id = {}, {}, [], [0] * 256
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            raw = b""
            if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED):
                raw = p.piece.replace(SPACE, " ").encode()
                if p.type == kinds.NORMAL:
                    self.id[p.piece], self.weight[p.piece] = i, -p.score
            elif p.type == kinds.BYTE:
                raw = bytes([int(p.piece[3:5], 16)])
                self.byte_id[raw[0]] = i
            elif p.type == kinds.UNKNOWN:
                self.unknown = i
            self.bytes_of.append(raw)
        self.fallback = proto.trainer_spec.byte_fallback
        self.pairs = {p[k:k + 2] for p in self.id for k in range(len(p) - 1)}       # neighbours that some arc joins
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in self.id), p[0]) for p in self.id if len(p) > 1}
        self.starts = {p[:k] for p in self.id for k in range(1, len(p) + 1)}
        self.worst = max(self.weight.values()) + 10.0      # weight of a character without a piece
        inner = any(SPACE in p.lstrip(SPACE) for p in self.id)
        held = set("".join(self.id))
        stop = "" if "\n" in held else "\n"
        self.words = None if inner else re.compile(f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+|\n")
        self.paths: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    def merge(self, s: str) -> list[str]:
        """The ranked merges of a short string (used on two neighbours)."""
        parts = list(s)
        weight = self.weight
        w = [weight.get(x + y, inf) for x, y in zip(parts, parts[1:])]
        while w:
            best = min(w)
            if best == inf:
                break
            k = w.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del w[k]
            if k:
                w[k - 1] = weight.get(parts[k - 1] + parts[k], inf)
            if k < len(w):
                w[k] = weight.get(parts[k] + parts[k + 1], inf)
        return parts

    def compatible(self, u: str, v: str) -> bool:
        key = (u, v)
        ok = self.fits.get(key)
        if ok is None:
            if len(self.fits) >= CACHE:
                self.fits.clear()
            ok = self.fits[key] = self.merge(u + v) == ([u, v] if u else [v])
        return ok

    def arcs(self, s: str) -> list[list[str]]:
        """Pieces that end at each position, longest first; a character
        without a piece is an arc of its own."""
        n, ids, starts = len(s), self.id, self.starts
        ends: list[list[str]] = [[] for _ in range(n + 1)]
        for i in range(n):
            j = i + 1
            t = s[i]
            if t not in ids:
                ends[j].append(t)
            while t in starts:
                if t in ids:
                    ends[j].append(t)
                if j == n:
                    break
                j += 1
                t = s[i:j]
        return ends

    def path(self, s: str) -> list[str]:
        """Pieces of the shortest path of a word."""
        if not self.unigram:
            return self.ranked_path(s)
        n = len(s)
        last = [""] * (n + 1)
        ends = self.arcs(s)
        cost = [0.0] + [inf] * n
        for j in range(1, n + 1):
            for t in ends[j]:
                w = cost[j - len(t)] + self.weight.get(t, self.worst)
                if w < cost[j]:
                    cost[j], last[j] = w, t
        out, j = [], n
        while j:
            out.append(last[j])
            j -= len(last[j])
        return out[::-1]

    def ranked_path(self, s: str) -> list[str]:
        """The one path of finite weight, depth first, longest arcs first.  A
        position has one live state, so a dead end there stays one."""
        n, fits, shorter, longest = len(s), self.fits, self.shorter, self.longest
        out: list[str] = []
        dead: set[int] = set()
        i, last, t = 0, "", longest(s, 0)
        while i < n:
            while t is not None:
                if i + len(t) not in dead:
                    ok = fits.get((last, t))
                    if ok if ok is not None else self.compatible(last, t):
                        break
                t = shorter.get(t)
            if t is not None:
                out.append(t)
                i += len(t)
                last, t = t, longest(s, i) if i < n else None
            else:
                dead.add(i)
                t = out.pop()
                i -= len(t)
                last, t = out[-1] if out else "", shorter.get(t)
        return out

    def longest(self, s: str, i: int) -> str:
        """The longest arc from position i (a character without a piece is one)."""
        starts, ids, n = self.starts, self.id, len(s)
        j = i + 1
        t = x = s[i]
        while x in starts:
            if x in ids:
                t = x
            if j == n:
                break
            j += 1
            x = s[i:j]
        return t

    def path_ids(self, s: str) -> bytes:
        got = self.paths.get(s)
        if got is None and (got := self.older.get(s)) is not None:
            self.paths[s] = got
        if got is None:
            pairs = self.pairs
            cuts = [k for k in range(1, len(s)) if s[k - 1:k + 1] not in pairs]
            if cuts:                                    # no arc passes a cut: the path is that of the parts
                got = b"".join(self.path_ids(s[a:b]) for a, b in zip([0, *cuts], [*cuts, len(s)]))
            else:
                got = self.path_bytes(s)
            if len(self.paths) >= CACHE:        # words not met since the last turn are forgotten
                self.older, self.paths = self.paths, {}
            if len(s) <= 64:
                self.paths[s] = got
        return got

    def path_bytes(self, s: str) -> bytes:
        out: list[int] = []
        for t in self.path(s):
            i = self.id.get(t)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out.extend(self.byte_id[b] for b in t.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, "<i4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        s = self.prefix + text.replace(" ", SPACE)
        words = self.words.findall(s) if self.words else [s]
        parts = list(map(self.paths.get, words))
        if None in parts:
            parts = [self.path_ids(w) if p is None else p for w, p in zip(words, parts)]
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> str:
        of = self.bytes_of
        raw = b"".join([of[i] for i in ids.tolist()])
        return raw[len(self.prefix):].decode(errors="replace") if self.prefix else raw.decode(errors="replace")


def encode(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """The documents' columns, ``ids`` (array of int), ``n_tokens`` and
    ``round_trip`` (the ids decode to the text).  ``model_file`` is read on
    the driver and broadcast; its size is fixed.  A clashing input column is
    replaced by the result."""
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    passed = [c for c in docs.columns if c not in ("ids", "n_tokens", "round_trip")]
    schema = docs.select(*passed).schema.add("ids", ArrayType(IntegerType())).add("n_tokens", "long").add("round_trip", "boolean")

    def run(batches):
        machine = once(("pieces", model.value), lambda: Transducer(model.value))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                col = rows.column(rows.schema.get_field_index(text_col))
                ids, ok = [], []
                for text in col.to_pylist():
                    text = text or ""
                    v = np.frombuffer(machine.encode(text), "<i4")
                    ids.append(v)
                    ok.append(machine.decode(v) == text)
                cut = np.concatenate([[0], np.cumsum([len(v) for v in ids])])
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in passed), lists, pa.array(np.diff(cut)), pa.array(ok)],
                                                 names=[*passed, "ids", "n_tokens", "round_trip"])
    return docs.select(*passed).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids") -> DataFrame:
    """The columns and ``decoded``, the text of the ids (null ids: null)."""
    with open(model_file, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())
    passed = [c for c in encoded.columns if c != "decoded"]

    def run(batches):
        machine = once(("pieces", model.value), lambda: Transducer(model.value))
        for rows in batches:
            texts = [None if v is None else machine.decode(np.asarray(v, np.int64)) for v in rows.column(rows.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in passed), pa.array(texts, pa.string())], names=[*passed, "decoded"])
    return encoded.select(*passed).mapInArrow(run, encoded.select(*passed).schema.add("decoded", "string"))
