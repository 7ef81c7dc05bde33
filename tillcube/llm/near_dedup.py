"""Near-duplicate groups by MinHash with tensored banding (operator 1).

A document's set holds its distinct shingles of ``size`` words (A-Z
lower-cased; with fewer words, the whole sequence is one shingle).  Two
documents are linked if the Jaccard similarity of their sets is at least
``percent`` / 100; groups are the connected components of the links.

Tables are keyed by pairs from two small collections: collection A and B
hold ``TABLES`` keys each, every key ``ROWS`` minhashes, and table (i, j) is
keyed by (A_i, B_j).  So TABLES^2 = 400 tables of 8 minhashes cost
2 * 20 * 4 = 160 minhashes a document instead of 3,200.  A pair of similarity
s meets in some table with probability (1 - (1 - s^4)^20)^2: 0.99994 at 0.8,
more above.

1. documents of equal sets are represented by their smallest id;
2. keys of a collection that occur once can meet nothing and go, before the
   pairs are formed from the rest;
3. every bucket names its smallest member as hub, and members are compared
   with hubs on their full sets.  Members of a bucket that are still in
   different groups are then compared with a hub of another choice;
4. the members of the buckets that stay open are joined exactly, by the rarest
   shingles of their sets: of a link both sides have a common one among their
   first n - ceil(n * percent / 100) + 1, so early that what is left of both
   sets can still make the link.  So no link between groups is lost, a bucket
   of one group costs its size only, and members with too many shingles of
   their own meet nobody.

A null or empty text has an empty set and is linked with nothing.  A null id
names no document: such rows get component_id null and kept true.  Rows that
repeat an id are one node, linked by each of its texts; each row gets its own
n_shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .files import drop_tables, store
from .text import U, chunks, grams, mix, tokenise

SIZE = 2
PERCENT = 80
TABLES = 20
ROWS = 4
HUB_ROUNDS = 1          # rounds of other hubs before the rest is joined by rare shingles
_SEEDS = mix(np.arange(1, 2 * TABLES * ROWS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_FACTORS = mix(np.arange(1, 2 * TABLES * ROWS + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)) | U(1)


def shingles(w, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their offsets."""
    n = np.diff(w.off)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    first = np.cumsum(count) - count
    k = np.arange(int(count.sum())) - np.repeat(first, count)
    full = np.repeat(n >= size, count)
    out = np.empty(len(doc), U)
    if full.any():
        out[full] = grams(w.hash, size)[w.off[doc[full]] + k[full]] if size > 1 else w.hash[w.off[doc[full]] + k[full]]
    for i in np.flatnonzero((n > 0) & (n < size)):          # the whole sequence, told apart by its length
        x = np.array([n[i]], U)
        for h in w.hash[w.off[i]:w.off[i + 1]]:
            x = mix(x * U(0x9FB21C651E98DF25) + h)
        out[first[i]] = x[0]
    out = mix(out)
    o = np.lexsort((out, doc)) if len(doc) else np.zeros(0, np.int64)
    out, doc = out[o], doc[o]
    if len(out):
        new = np.concatenate([[True], (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])])
        out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(len(n) + 1))


def signatures(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """2 * TABLES keys a document (its row is meaningless where the set is empty)."""
    filled = np.flatnonzero(np.diff(off))
    keys = np.zeros((len(off) - 1, 2 * TABLES), U)
    if not len(filled):
        return keys
    at = off[filled]
    for t in range(2 * TABLES):
        key = np.full(len(filled), U(t + 1))
        for r in range(ROWS):
            i = t * ROWS + r
            low = np.minimum.reduceat((sets ^ _SEEDS[i]) * _FACTORS[i], at)
            key = mix(key * U(0x9FB21C651E98DF25) + low)
        keys[filled, t] = key
    return keys


PRINTS = ["n", "print1", "print2"]      # tell sets apart: their size and two 64-bit sums of hashes


def _shingled(size: int, what: str):
    """Per row its id, the prints of its set, and its ``keys`` or its whole ``set``."""
    schema = pa.schema([("id", pa.int64()), *((c, pa.int64()) for c in PRINTS), (what, pa.list_(pa.int64()))])

    def run(batches):
        for rows, data, off in chunks(batches):
            sets, at = shingles(tokenise(data, off, lower=True), size)
            total = [np.concatenate([[U(0)], np.cumsum(x)]) for x in (sets, mix(sets * U(0xC2B2AE3D27D4EB4F)))]
            prints = [(t[at[1:]] - t[at[:-1]]).view(np.int64) for t in total]
            values, cut = (sets, at) if what == "set" else (signatures(sets, at).ravel(), np.arange(len(at)) * 2 * TABLES)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at)), *map(pa.array, prints),
                                              pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(values.view(np.int64)))], schema=schema)
    return run


def _with_prints(docs: DataFrame, size: int, what: str) -> DataFrame:
    return docs.select("id", "text").mapInArrow(_shingled(size, what), f"id long, n long, print1 long, print2 long, {what} array<long>")


def _verify(percent: int):
    """Keeps the pairs whose full sets are similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            xo, yo = (np.asarray(c.offsets) - c.offsets[0].as_py() for c in (x, y))
            xv, yv = x.flatten().to_numpy().view(U), y.flatten().to_numpy().view(U)
            ok = []
            for i in range(batch.num_rows):
                p, q = xv[xo[i]:xo[i + 1]], yv[yo[i]:yo[i + 1]]
                if len(p) > len(q):
                    p, q = q, p
                place = np.searchsorted(q, p)
                place[place == len(q)] = 0
                both = int((q[place] == p).sum())
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], schema=schema)
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable, for every node of the edges
    (a, b).  Each round joins all neighbours of a node to the smallest of
    them; it ends when every node hangs on the smallest directly."""
    edges = store(edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u > v").distinct(), "links")
    while True:
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                              F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
        bent = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1")
        if not bent.limit(1).count():                # every node hangs on one that hangs on none
            return edges.selectExpr("u AS node", "v AS comp")
        both = edges.union(edges.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        nxt = both.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        nxt = store(nxt.select("e.u", "e.v").filter("u > v").distinct(), "links")
        drop_tables(edges)
        edges = nxt


def _rare_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different groups among the members (sid, rep, n,
    comp), by their rarest shingles: every link between them is among these."""
    own = members.join(sets, "sid").select("sid", "rep", "n", "comp", F.explode("set").alias("shingle"))
    counts = own.groupBy("shingle").agg(F.count("*").alias("c"))
    order = Window.partitionBy("sid").orderBy("c", "shingle")
    ranked = own.join(counts, "shingle").withColumn("at", F.row_number().over(order))
    first = ranked.filter(f"c > 1 AND at <= n - ({percent} * n + 99) div 100 + 1").drop("c")
    first = store(first, "rare-shingles")
    a = first.selectExpr("shingle", "sid AS a", "rep AS ra", "n AS na", "comp AS ca", "at AS ia")
    b = first.selectExpr("shingle", "sid AS b", "rep AS rb", "n AS nb", "comp AS cb", "at AS ib")
    return a.join(b, "shingle").filter(f"a < b AND ca <> cb AND {100 + percent} * (1 + least(na - ia, nb - ib)) >= {percent} * (na + nb)")


def links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(id, n) of every row and (node, comp) of all nodes that have a partner.  ``docs``: (id long, text)."""
    signed = store(_with_prints(docs, size, "keys"), "signatures")
    some = signed.filter("n > 0 AND id IS NOT NULL")
    # one row a set: its smallest id stands for all of them
    reps = some.groupBy(*PRINTS).agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("keys").alias("keys"))
    reps = store(reps.withColumn("sid", F.monotonically_increasing_id()), "representatives")
    sizes = store(signed.select("id", "n"), "set-sizes")
    same = some.select("id", *PRINTS).join(reps.filter("copies > 1").select(*PRINTS, "rep"), PRINTS).selectExpr("id AS a", "rep AS b").filter("a <> b")
    keys = reps.select("sid", "rep", "n", F.posexplode("keys").alias("t", "key"))
    shared = keys.groupBy("t", "key").agg(F.count("*").alias("c")).filter("c > 1").select("t", "key")
    live = keys.join(shared, ["t", "key"]).groupBy("sid", "rep", "n").agg(F.collect_list(F.struct("t", "key")).alias("ks"))
    live = live.select("sid", "rep", "n", F.expr(f"transform(filter(ks, k -> k.t < {TABLES}), k -> k.key)").alias("ka"),
                       F.expr(f"transform(filter(ks, k -> k.t >= {TABLES}), k -> k.key)").alias("kb"))
    live = store(live, "shared-keys")
    # the full sets of all documents that can meet another are made once, for every comparison below
    mine = reps.join(live.select("sid"), "sid", "left_semi").selectExpr("rep AS id", *PRINTS, "sid")
    texts = docs.join(mine.select("id").distinct(), "id", "left_semi")
    sets = store(_with_prints(texts, size, "set").join(mine, ["id", *PRINTS]).select("sid", "set").dropDuplicates(["sid"]), "sets")
    tables = live.select("sid", "rep", "n", F.explode("ka").alias("ka"), "kb").select("sid", "rep", "n", "ka", F.explode("kb").alias("kb"))
    tables = tables.select("sid", "rep", "n", F.xxhash64("ka", "kb").alias("key"))
    several = tables.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    members = store(tables.join(several, "key"), "buckets")

    def compare(pairs: DataFrame) -> DataFrame:
        """Links of the verified ones of the pairs (a, na, ra, b, nb, rb); sizes rule most out."""
        pairs = pairs.filter(f"a <> b AND ra <> rb AND 100 * least(na, nb) >= {percent} * greatest(na, nb)")
        pairs = pairs.selectExpr("least(a, b) AS a", "greatest(a, b) AS b", "least(ra, rb) AS ra", "greatest(ra, rb) AS rb").distinct()
        full = pairs.join(sets.selectExpr("sid AS a", "set AS x"), "a").join(sets.selectExpr("sid AS b", "set AS y"), "b")
        return store(full.select("ra", "rb", "x", "y").mapInArrow(_verify(percent), "a long, b long"), "links")

    def with_hub(buckets: DataFrame) -> DataFrame:
        return buckets.filter("sid <> h.sid").selectExpr("sid AS a", "n AS na", "rep AS ra", "h.sid AS b", "h.n AS nb", "h.rep AS rb")

    hubs = members.groupBy("key").agg(F.min(F.struct("rep", "sid", "n")).alias("h"))
    found = compare(with_hub(members.join(hubs, "key")))
    comp = components(found.union(same))
    drop_tables(found, signed)
    open_ = members
    for step in range(HUB_ROUNDS + 1):
        # a bucket stays open while it holds members of several groups
        placed = open_.select("key", "sid", "rep", "n").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", "sid", "rep", "n", F.coalesce("comp", "rep").alias("comp"))
        mixed = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                          F.max(F.struct(F.xxhash64("sid", F.lit(step)).alias("o"), "sid", "rep", "n", "comp")).alias("h")).filter("x < y")
        still = store(placed.join(mixed.select("key", "h"), "key"), "open-buckets")
        drop_tables(open_)
        open_ = still
        found = compare(with_hub(open_.filter("comp <> h.comp")) if step < HUB_ROUNDS else _rare_pairs(open_.select("sid", "rep", "n", "comp").distinct(), sets, percent))
        new = components(comp.selectExpr("node AS a", "comp AS b").union(found))
        drop_tables(comp, found)
        comp = new
    drop_tables(open_, live, reps, sets)
    return sizes, comp


def groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept."""
    signed, comp = links(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), size, percent)
    return signed.select("id", "n").join(comp.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("comp", "id").alias("component_id"),
        F.coalesce(F.coalesce("comp", "id") == F.col("id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all columns) without the members of a group but its
    smallest id.  Rows that repeat a kept id stay."""
    _, comp = links(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), size, percent)
    node = next(c for i in range(len(docs.columns) + 1) if (c := f"node{i}") not in docs.columns)
    gone = comp.filter("node <> comp").select(F.col("node").alias(node))
    return docs.join(gone, F.col(id_col).cast("long") == F.col(node), "left_anti")
