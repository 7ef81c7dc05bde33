"""Merkle manifest of a dataset (operator 13), with DataFrame functions only.

Every row is a leaf: the sha256 of its fields, each written as ``-`` (null) or
as byte count, ``:`` and value.  The leaves of one group ascend by id and
every ``FAN`` consecutive nodes have one parent, the hash of their
concatenated hex digests, until one node remains: the group's subroot.  The
subroots, in group order, give the root by the same rule.

Per level, lag and lead columns of the fixed offsets 1 to FAN - 1, masked by
a node's slot in its run and by the run's length, supply its siblings, and
the rows of slot 0 hash their run's parent.  The windows lie over blocks of
``BLOCK`` nodes of a group (whole runs), so a group that holds a third of all
rows is spread over many tasks and no window sees more than a block.  Node
numbers come from a range partition by (group, id, leaf) and one counter a
(partition, group).  Siblings then go down again: a node's path is its own
siblings and its parent's path, so joins shrink by FAN a level.

A null id or field is written ``-``; a null group is a group of its own, the
first.  Rows that repeat an id are leaves of their own, ordered by their leaf
hash.  Nulls, empty and very long texts need no other rule.  An empty table
has no root and no proofs.  Columns that are not named are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.keys import sequential_key
from .files import drop_tables, store

FAN = 8
BLOCK = FAN ** 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64                # characters of a digest


def leaf_hash(fields: list[Column]) -> Column:
    """sha256 of the fields' self-delimiting forms."""
    form = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*form), 256)


@dataclass
class Manifest:
    """Written node tables, bottom up: of the groups, then of their subroots.
    Columns: tree, pos, n (nodes of the level), hash, sibs (siblings left to
    right), parent (of slot 0); level 0 of the groups carries the rows' own."""

    groups: list[DataFrame]
    roots: list[DataFrame]

    def root(self) -> DataFrame:
        """The dataset's root, one row (none for an empty table), and its tree (0)."""
        return self.roots[-1].filter("n = 1").selectExpr("hash AS root", "tree")

    def drop(self) -> None:
        """Delete the node tables (once what was read from them is written)."""
        drop_tables(*self.groups, *self.roots)


def _numbered(leaves: DataFrame) -> DataFrame:
    """tree (rank of the group), pos (rank in the group) and n (its rows) of
    the leaves (grp, id, hash, ...)."""
    order = [F.col(c).asc_nulls_first() for c in ("grp", "id", "hash")]
    ranged = (leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
              .withColumn("at", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33)))
    ranged = store(ranged, "manifest-order")
    runs = ranged.groupBy("part", "grp").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    in_group = Window.partitionBy("grp")
    runs = runs.select("part", "grp", "first", F.sum("rows").over(in_group).alias("n"),
                       F.coalesce(F.sum("rows").over(in_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    trees = sequential_key(runs.select("grp").distinct(), "grp", "tree").selectExpr("grp AS g", "tree - 1 AS tree")
    runs = runs.join(trees, F.col("grp").eqNullSafe(F.col("g"))).select(F.col("part").alias("p"), "g", "tree", "n", F.expr("before - first").alias("shift"))
    return ranged.join(runs, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "p", "g", "shift")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """The nodes of one level with their siblings and, at slot 0, the parent."""
    block = Window.partitionBy("tree", F.expr(f"pos div {BLOCK}")).orderBy("pos")
    nodes = nodes.withColumn("slot", F.expr(f"CAST(pos % {FAN} AS INT)")).withColumn("width", F.expr(f"least({FAN}, n - pos + slot)"))
    empty = F.lit("")
    left = [F.when(F.col("slot") >= k, F.lag("hash", k).over(block)).otherwise(empty) for k in range(FAN - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < F.col("width"), F.lead("hash", k).over(block)).otherwise(empty) for k in range(1, FAN)]
    nodes = nodes.withColumn("sibs", F.concat(*left, *right))
    return nodes.withColumn("parent", F.when(F.expr("slot = 0 AND n > 1"), F.sha2(F.concat("hash", "sibs"), 256))).drop("width")


def _climb(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Node tables of all levels; a tree is in those up to its root (n = 1)."""
    levels = []
    while True:
        levels.append(store(_with_siblings(nodes), name))
        if largest <= 1:
            return levels
        largest = -(-largest // FAN)
        nodes = levels[-1].filter("parent IS NOT NULL").selectExpr("tree", f"pos div {FAN} AS pos", f"(n + {FAN - 1}) div {FAN} AS n", "parent AS hash")


def _descend(levels: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of level 0 with their paths up through ``tops`` (top, path,
    ...), whose further columns every node gets."""
    given = [c for c in tops.columns if c != "top"]
    above = None
    for k, level in reversed(list(enumerate(levels))):
        own = ["tree", "pos", *(carried if not k else [])]
        done = level.filter("n = 1").join(tops, F.col("tree") == F.col("top")).select(*own, *given)
        if above is not None:
            up = above.select(F.col("tree").alias("top"), F.col("pos").alias("run"), *given)
            here = level.filter("n > 1").withColumn("of", F.expr(f"pos div {FAN}")).join(up, F.expr("tree = top AND of = run"))
            path = F.concat(F.array(F.struct("slot", "sibs")), "path").alias("path")
            done = done.union(here.select(*own, *[path if c == "path" else c for c in given]))
        above = done
    return above


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", claim: Column | None = None) -> Manifest:
    """The manifest of the rows.  ``claim``: a leaf hash to be verified in a
    row's place (null: its own), kept beside the leaf."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf_hash([F.col(c) for c in fields]).alias("hash"),
                       (F.lit(None).cast("string") if claim is None else claim).alias("claim"))
    leaves = store(rows, "manifest-leaves")          # the texts are read and hashed once
    nodes = _numbered(leaves)
    groups = _climb(nodes, nodes.agg(F.max("n")).head()[0] or 0, "manifest-nodes")
    subroots = functools.reduce(DataFrame.union, [level.filter("n = 1").select("tree", "hash") for level in groups])
    trees = subroots.count()
    top = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees).cast("long").alias("n"), "hash")
    roots = _climb(top, trees, "manifest-roots")
    drop_tables(leaves)
    return Manifest(groups, roots)


def proofs(manifest: Manifest) -> DataFrame:
    """id, grp, leaf, claim, subroot, root and path of every row: its siblings
    level by level up to the root, as (slot, sibs) with sibs left to right."""
    root = manifest.root().select(F.col("tree").alias("top"), F.expr("CAST(array() AS array<struct<slot: int, sibs: string>>)").alias("path"), "root")
    subroots = _descend(manifest.roots, root, ["hash"]).select(F.col("pos").alias("top"), "path", F.col("hash").alias("subroot"), "root")
    return _descend(manifest.groups, subroots, ["id", "grp", "hash", "claim"]).select("id", "grp", F.col("hash").alias("leaf"), "claim", "subroot", "root", "path")


def fold(leaf: str = "leaf", path: str = "path") -> Column:
    """The root that a leaf and its path give."""
    return F.expr(f"aggregate({path}, {leaf}, (h, s) -> sha2(concat(substring(s.sibs, 1, {HEX} * s.slot), h, substring(s.sibs, {HEX} * s.slot + 1)), 256))")


def digests(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """The contract's columns: every row's proof, and whether its claim folds to the root."""
    got = proofs(build(docs, claim=claim)).withColumn("claimed", F.coalesce("claim", "leaf")).withColumn("folded_root", fold("claimed"))
    return got.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.array_join(F.transform("path", lambda s: s.sibs), ""), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered_claim(share: int = 3, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Leaf hash of the row with its text's A-Z lower-cased, where ``share``
    divides the crc32 of the decimal id, else null (so with a null id)."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % share == 0
    return F.when(hit, leaf_hash([lower if c == text_col else F.col(c) for c in fields]))
