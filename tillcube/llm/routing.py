"""Content routing of repeated strings, shared by the two substring dedups.

Every run of ``length`` symbols (a window) has as anchor the smallest hash of
its ``q``-grams.  Equal windows have equal anchors, so all places where a
window occurs meet under one anchor, whatever the documents.  A segment is a
run of consecutive windows of a document with one anchor.  Work and shuffle
stay linear in the input:

1. anchors that occur once in the whole corpus can hold no repeated window;
   their segments go;
2. equal segments (copies, shared passages) are reduced to their first
   occurrence with partial aggregates before any text moves;
3. the texts of the first occurrences go to shards by anchor;
4. an anchor with more than ``hot`` different segments (the edges of a
   passage that many documents share) is taken apart into windows, which are
   pruned and reduced as in 1 and 2 by their own hash, and routed by it, so
   no shard holds more than ``hot`` segments of an anchor.

Documents are named by ``dk`` (the integer id, null as the smallest long) and
``tie`` (0; where ids repeat, a hash of the text), ``pos`` packs the first
window and the number of windows of a segment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import new_table_path
from .files import drop_tables
from .text import U, chunks, cover, grams, mix, runs_of

SPAN = 1 << 12           # windows of a segment, at most SPAN - 1
_M = U(0xC4CEB9FE1A85EC53)
_M_INV = U(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
L0 = "anchor long, seg long, dk long, tie long, pos long, weight long"


@dataclass(frozen=True)
class Spec:
    """``symbols(data, off)`` -> (symbols as uint64 or bytes, offsets of the texts)."""
    length: int
    q: int
    symbols: object
    code: np.dtype            # how a symbol travels
    hot: int = 2_000
    shard: int = 400_000      # symbols in a shard, about

    @property
    def longest(self) -> int:
        return min(SPAN - 1, 4 * (self.length - self.q + 1))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(dk, tie, text): the documents under their routing key; the tie's
    metadata say whether ids repeat (see ``has_ties``)."""
    ids = docs.select(F.col(id_col).alias("i"))
    unique = ids.groupBy("i").count().filter("count > 1").limit(1).count() == 0
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("dk"),
                       (F.lit(0).cast("long") if unique else F.xxhash64(text_col)).alias("tie", metadata={"ties": not unique}),
                       F.col(text_col).alias("text"))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the segment hash and of its inverse, kept for the next chunk."""
    if not _POWERS or len(_POWERS[0]) < n + 1:
        _POWERS[:] = [np.cumprod(np.concatenate([[U(1)], np.full(n, m, U)])) for m in (_M, _M_INV)]
    return _POWERS[0], _POWERS[1]


def segments(sym: np.ndarray, off: np.ndarray, spec: Spec):
    """Per segment: anchor, hash, text, first window, number of windows, and
    2 where its anchor stands at several places of it (so windows may repeat
    within the segment), else 1."""
    n, L = len(sym), spec.length
    if n < L:
        return None
    g = grams(sym, spec.q)
    w, width, m = L - spec.q + 1, 1, g
    while width * 2 <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < w:
        m = np.minimum(m[:len(m) - (w - width)], m[w - width:])
    bad = np.zeros(n + 1, np.int32)            # windows that would pass the end of a text
    lo, hi = np.maximum(off[:-1], off[1:] - L + 1), off[1:]
    np.add.at(bad, lo, 1)
    np.add.at(bad, hi, -1)
    valid = np.cumsum(bad[:len(m)]) == 0
    same = np.zeros(len(m), bool)
    same[1:] = (m[1:] == m[:-1]) & valid[:-1]
    twin = np.zeros(len(m) + 1, np.int64)
    twin[1:-1] = np.cumsum((g[:len(m) - 1] == m[:-1]) & same[1:])
    twin[-1] = twin[-2]
    first = np.flatnonzero(valid & ~same)
    if not len(first):
        return None
    last = np.zeros(len(m), bool)
    last[:-1] = ~(same[1:] & valid[1:])
    last[-1] = True
    last = np.flatnonzero(valid & last)
    count = last - first + 1
    if int(count.max()) > spec.longest:          # cut long runs (periodic text)
        parts = -(-count // spec.longest)
        k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        end = np.repeat(last + 1, parts)
        first = np.repeat(first, parts) + k * spec.longest
        count = np.minimum(end - first, spec.longest)
    power, inv = _powers(n)
    h = np.zeros(n + 1, U)
    np.cumsum((sym + U(1)) * power[:n], out=h[1:])
    stop = first + count + L - 1
    seg = mix((h[stop] - h[first]) * inv[first] + count.astype(U))
    doc = np.searchsorted(off, first, "right") - 1
    weight = 1 + (twin[first + count - 1] > twin[first])
    return m[first], seg, doc, first - off[doc], count, weight


def _emit(spec: Spec):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in L0.split(", ")])

    def run(batches):
        for rows, data, off in chunks(batches):
            sym, at = spec.symbols(data, off)
            got = segments(sym, at, spec)
            if got is None:
                continue
            anchor, seg, doc, first, count, weight = got
            key = [rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False)[doc] for c in ("dk", "tie")]
            cols = [anchor.view(np.int64), seg.view(np.int64), *key, first * SPAN + count, weight]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], schema=schema)
    return run


def flagged(docs: DataFrame, spec: Spec) -> DataFrame:
    """Documents with a segment whose anchor occurs twice or more: dk, tie,
    text and ``segs``, an array of (pos, anchor, hot, copies, first), where
    ``first`` says that the segment is the first of its equals and ``copies``
    how many there are.  Written to the shared folder."""
    spark = docs.sparkSession
    l0 = docs.mapInArrow(_emit(spec), L0)
    anchors = l0.groupBy("anchor").agg(F.sum("weight").alias("n")).filter("n > 1")
    path = new_table_path(spark, "repeat-occurrences")
    l0.drop("weight").join(anchors.select("anchor"), "anchor").write.parquet(path)
    occ = spark.read.parquet(path)
    firsts = occ.groupBy("anchor", "seg").agg(F.count("*").alias("copies"), F.min(F.struct("dk", "tie", "pos")).alias("f"))
    hot = firsts.groupBy("anchor").count().filter(F.col("count") > spec.hot).select("anchor", F.lit(True).alias("hot"))
    marked = occ.join(firsts.filter("copies > 1"), ["anchor", "seg"], "left").join(hot, "anchor", "left")
    lists = marked.groupBy("dk", "tie").agg(F.collect_set(F.struct(
        "pos", "anchor", F.coalesce("hot", F.lit(False)).alias("hot"), F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce(F.struct("dk", "tie", "pos") == F.col("f"), F.lit(True)).alias("first"))).alias("segs"))
    path = new_table_path(spark, "repeat-documents")
    once = docs.dropDuplicates(["dk", "tie"]) if has_ties(docs) else docs
    once.join(lists, ["dk", "tie"]).write.parquet(path)
    drop_tables(occ)
    return _with_windows(spark.read.parquet(path), spec)


def _with_windows(flag: DataFrame, spec: Spec) -> DataFrame:
    """Adds ``wins``: of the first segments of hot anchors, the windows that
    occur twice or more, as (start, hash, copies, first)."""
    hot = flag.filter("exists(segs, s -> s.hot AND s.first)")
    if not hot.limit(1).count():
        return flag.withColumn("wins", F.expr("cast(array() AS array<struct<start:bigint,route:bigint,copies:bigint,first:boolean>>)"))
    one = hot.mapInArrow(_hot_windows(spec), "dk long, tie long, begin long, routes array<long>")
    one = one.select("dk", "tie", "begin", F.posexplode("routes").alias("k", "route")).select("dk", "tie", "route", (F.col("begin") + F.col("k")).alias("start"))
    kept = one.groupBy("route").agg(F.count("*").alias("copies"), F.min(F.struct("dk", "tie", "start")).alias("f")).filter("copies > 1")
    wins = one.join(kept, "route").groupBy("dk", "tie").agg(F.collect_set(F.struct(
        "start", "route", "copies", (F.struct("dk", "tie", "start") == F.col("f")).alias("first"))).alias("wins"))
    return flag.join(wins, ["dk", "tie"], "left")


def _hot_windows(spec: Spec):
    schema = pa.schema([("dk", pa.int64()), ("tie", pa.int64()), ("begin", pa.int64()), ("routes", pa.list_(pa.int64()))])

    def run(batches):
        for rows, data, off in chunks(batches):
            sym, at = spec.symbols(data, off)
            doc, f = structs(rows, "segs")
            pick = np.flatnonzero(f["hot"] & f["first"])
            doc, begin, count = doc[pick], f["pos"][pick] // SPAN, f["pos"][pick] % SPAN
            k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            route = grams(sym, spec.length)[np.repeat(at[doc] + begin, count) + k] if len(k) else np.zeros(0, U)
            key = [rows.column(rows.schema.get_field_index(c)).to_numpy()[doc] for c in ("dk", "tie")]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(route.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(key[0]), pa.array(key[1]), pa.array(begin), lists], schema=schema)
    return run


def structs(rows: pa.RecordBatch, column: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row number and fields of the elements of an array-of-structs column."""
    col = rows.column(rows.schema.get_field_index(column))
    lens = np.asarray(pc.fill_null(pc.list_value_length(col), 0))
    flat = col.flatten()
    return np.repeat(np.arange(rows.num_rows), lens), {
        flat.type.field(i).name: flat.field(i).to_numpy(zero_copy_only=False).astype(bool if flat.type.field(i).type == pa.bool_() else np.int64)
        for i in range(flat.type.num_fields)}


def has_ties(docs: DataFrame) -> bool:
    """Whether ``keyed`` found repeated ids (the tie is then no literal)."""
    return docs.schema["tie"].metadata["ties"]


PIECES = "route long, dk long, tie long, start long, copies long, sym binary"


def _extract(spec: Spec):
    schema = pa.schema([("route", pa.int64()), ("dk", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("copies", pa.int64()), ("sym", pa.binary())])

    def run(batches):
        L = spec.length
        for rows, data, off in chunks(batches):
            sym, at = spec.symbols(data, off)
            travel = sym.astype(spec.code)
            doc, f = structs(rows, "segs")
            cold = np.flatnonzero(f["first"] & ~f["hot"])
            wdoc, g = structs(rows, "wins")
            one = np.flatnonzero(g["first"])
            s0 = np.concatenate([f["pos"][cold] // SPAN, g["start"][one]])
            c0 = np.concatenate([f["pos"][cold] % SPAN, np.ones(len(one), np.int64)])
            a0, n0 = np.concatenate([f["anchor"][cold], g["route"][one]]), np.concatenate([f["copies"][cold], g["copies"][one]])
            d0 = np.concatenate([doc[cold], wdoc[one]])
            b, e = at[d0] + s0, at[d0] + s0 + c0 + L - 1
            raw = [travel[x:y].tobytes() for x, y in zip(b.tolist(), e.tolist())]
            key = [rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False)[d0] for c in ("dk", "tie")]
            yield pa.RecordBatch.from_arrays([pa.array(a0), pa.array(key[0]), pa.array(key[1]), pa.array(s0), pa.array(n0), pa.array(raw, pa.binary())], schema=schema)
    return run


RUNS = "dk long, tie long, starts array<long>, ends array<long>"


def _shards(spec: Spec, repeated):
    """``repeated(sym, off, copies)`` says of each symbol of the pieces (in
    document order) whether the window that starts there is to go."""
    schema = pa.schema([("dk", pa.int64()), ("tie", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def solve(t: pa.Table):
        dk, tie, start, copies = (t.column(c).to_numpy() for c in ("dk", "tie", "start", "copies"))
        o = np.lexsort((start, tie, dk))         # text order in the shard = order of the windows
        raw = t.column("sym").combine_chunks().take(pa.array(o))
        data, off = np.frombuffer(raw.buffers()[2] or b"", np.uint8), np.frombuffer(raw.buffers()[1], np.int32)[:len(o) + 1].astype(np.int64)
        sym = np.frombuffer(data[off[0]:off[-1]].tobytes(), spec.code)
        off = (off - off[0]) // np.dtype(spec.code).itemsize
        dk, tie, start, copies = dk[o], tie[o], start[o], copies[o]
        a, b = runs_of(repeated(sym, off, copies))
        if not len(a):
            return None
        piece = np.searchsorted(off, a, "right") - 1
        a, b = a - off[piece] + start[piece], b - off[piece] + start[piece]
        new = np.flatnonzero(np.concatenate([[True], (dk[piece][1:] != dk[piece][:-1]) | (tie[piece][1:] != tie[piece][:-1])]))
        cut = pa.array(np.append(new, len(a)).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(dk[piece][new]), pa.array(tie[piece][new]),
                                           pa.ListArray.from_arrays(cut, pa.array(a)), pa.ListArray.from_arrays(cut, pa.array(b))], schema=schema)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        del held
        t = t.take(pa.array(np.argsort(t.column("route").to_numpy(), kind="stable")))
        size = np.cumsum(np.asarray(pc.binary_length(t.column("sym")))) // np.dtype(spec.code).itemsize
        route = t.column("route").to_numpy()
        edge = np.append(np.flatnonzero(route[1:] != route[:-1]) + 1, len(route))
        i = 0
        while i < len(route):                    # whole routes, about a shard's size together
            base = size[i - 1] if i else 0
            k = np.searchsorted(size[edge - 1], base + spec.shard, "right") - 1
            j = int(max(edge[k] if k >= 0 else 0, edge[np.searchsorted(edge, i, "right")]))
            out = solve(t.slice(i, j - i))
            if out is not None:
                yield out
            i = j
    return run


def repeated_windows(flag: DataFrame, spec: Spec, repeated) -> DataFrame:
    """(dk, tie, text, segs, runs): the flagged documents with the runs of
    windows that the shards judged repeated (of first occurrences only)."""
    L = spec.length
    total = flag.select(F.expr(f"aggregate(filter(segs, s -> s.first AND NOT s.hot), 0L, (a, s) -> a + s.pos % {SPAN} + {L - 1})"
                               f" + greatest(0, coalesce(size(filter(wins, w -> w.first)), 0)) * {L}").alias("n")).agg(F.sum("n")).first()[0] or 0
    pieces = flag.select("dk", "tie", "text", "segs", "wins").mapInArrow(_extract(spec), PIECES)
    shards = pieces.repartition(max(1, -(-total // spec.shard)), "route").mapInArrow(_shards(spec, repeated), RUNS)
    runs = shards.groupBy("dk", "tie").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    return flag.join(runs, ["dk", "tie"], "left")


def removed_mask(rows: pa.RecordBatch, at: np.ndarray, spec: Spec, all_copies: bool) -> np.ndarray:
    """Symbols of the chunk covered by a window that goes: those that the
    shards found and those of repeated segments (all copies, or all but the
    first)."""
    doc, f = structs(rows, "segs")
    gone = np.flatnonzero(f["copies"] > 1 if all_copies else ~f["first"])
    s = [at[doc[gone]] + f["pos"][gone] // SPAN]
    e = [s[0] + f["pos"][gone] % SPAN]
    doc, f = structs(rows, "wins")
    gone = slice(None) if all_copies else np.flatnonzero(~f["first"])
    s.append(at[doc[gone]] + f["start"][gone])
    e.append(s[1] + 1)
    a, b = (rows.column(rows.schema.get_field_index(c)) for c in ("starts", "ends"))
    doc = np.repeat(np.arange(rows.num_rows), np.asarray(pc.fill_null(pc.list_value_length(a), 0)))
    s.append(at[doc] + a.flatten().to_numpy())
    e.append(at[doc] + b.flatten().to_numpy())
    return cover(np.concatenate(s), np.concatenate(e) + spec.length - 1, int(at[-1]))


def per_chunk(fn, schema: pa.Schema):
    """A mapInArrow task that turns each chunk (rows, data, off) into a batch."""
    def run(batches):
        for rows, data, off in chunks(batches):
            yield pa.RecordBatch.from_arrays(fn(rows, data, off), schema=schema)
    return run
