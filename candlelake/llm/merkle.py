"""Merkle manifest of a table: the tree's levels as stored node rows, proofs by a recursive climb.

Rows are leaves, grouped (by source, say) and ordered by id in their group. Runs of ``fan`` leaves, then of
nodes, become one node each until a group has one node, its subroot; the subroots, ordered by group,
become the root in the same way. Every node is stored with its parent's name, its place there and the
digests of its children one after the other. A recursive query then climbs these links to the root: at every node it appends the
siblings to the proof and folds the digest of what was presented for a leaf. The leaves of one run share all
siblings above their run, so one row climbs for a run, with the folded digest of each of its leaves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.common import stored

#: Nodes of a run.
FAN = 16
#: Tree number of the nodes above the subroots.
TOP = -1
LEVEL = "tree bigint, level int, at bigint, n bigint, hash binary, children binary"

#: Bytes of a digest. Tables hold digests as bytes; what is hashed is their lower-case hex text.
WIDTH = 32

#: One step joins a node's parent: the siblings are the bytes before and after the node's own digest among the parent's children.
CLIMB = """
    WITH RECURSIVE climb(run, parent, place, hash, subroot, folds, proof) AS (
        SELECT node, parent, place, hash, subroot, folds, CAST('' AS BINARY) FROM {runs}
        UNION ALL
        SELECT run, parent, place, hash, subroot, transform(folds, f -> unhex(sha2(CAST(lower(hex(concat(before, f, after))) AS BINARY), 256))), concat(proof, before, after) FROM (
            SELECT c.run, n.parent, n.place, n.hash, coalesce(c.subroot, n.subroot) AS subroot, c.folds, c.proof,
                   substring(n.children, 1, c.place * {width}) AS before, substring(n.children, c.place * {width} + {width} + 1) AS after
            FROM climb c JOIN {nodes} n ON n.node = c.parent
        )
    )
    SELECT run, hash AS root, subroot, folds, proof FROM climb WHERE parent IS NULL
"""


@dataclass
class Manifest:
    """leaves: one row per run of leaves; nodes: one row per node; both stored in the shared work folder."""

    leaves: DataFrame
    nodes: DataFrame
    fan: int


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def sha(digests: Column) -> Column:
    """The digest (bytes) of digests (bytes, one after the other)."""
    return F.unhex(F.sha2(hexed(digests).cast("binary"), 256))


def joined(digests: Column) -> Column:
    return F.aggregate(digests, F.unhex(F.lit("")), lambda have, x: F.concat(have, x))


def record_digest(*fields: Column) -> Column:
    """Digest of a record, as hex text: each field is ``-`` if NULL, else its UTF-8 byte count, ``:`` and its value as text."""
    texts = [f.cast("string") for f in fields]
    record = F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    return F.sha2(record.cast("binary"), 256)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``seat``, their place from 0 in the whole table's order (NULL first). Sorted by range, so no task sees all rows.

    A row's place is its place in its partition after the rows of all partitions before; these sums have a row per partition.
    """
    held = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_row", 33)
    sizes = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_here"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"))
    return held.withColumn("_part", part).join(sizes, "_part").withColumn("seat", F.col("_before") + F.col("_row").bitwiseAND((1 << 33) - 1)).drop("_part", "_row", "_before")


def above(nodes: DataFrame, fan: int) -> DataFrame:
    """The next level over the trees that still have several nodes."""
    up = nodes.filter("n > 1").groupBy("tree", (F.col("level") + 1).alias("level"), F.floor(F.col("at") / fan).alias("up"), F.ceil(F.col("n") / fan).alias("n"))
    up = up.agg(joined(F.array_sort(F.collect_list(F.struct("at", "hash")))["hash"]).alias("children"))
    return up.select("tree", "level", F.col("up").alias("at"), "n", sha(F.col("children")).alias("hash"), "children")


def levels(nodes: DataFrame, fan: int) -> list[DataFrame]:
    """``nodes`` (columns of LEVEL) and all levels above them, each stored; as many as a tree is high."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(stored(above(out[-1], fan), "merkle-level"))
    return out


def build(rows: DataFrame, doc_id: Column, group: Column, leaf: Column, presented: Column | None = None, fan: int = FAN) -> Manifest:
    """The manifest of ``rows``, whose digests ``leaf`` (hex text of 256 bits) are the leaves.

    group and doc_id say which tree a leaf stands in and where; groups are ordered as UTF-8 bytes, ids ascend,
    NULL first in both. Rows of one group and id are ordered by their digests, so repeated rows are
    leaves of their own. ``presented`` is the digest of what a later reader found in the row's place
    (default: the leaf), which proofs() folds. Other columns are not read. An empty table has no nodes.
    """
    found = leaf if presented is None else presented
    base = stored(rows.select(group.alias("key"), doc_id.alias("doc_id"), F.unhex(leaf).alias("leaf"), F.unhex(found).alias("presented")), "merkle-leaves")
    seated = numbered(base, "key", "doc_id", "leaf")
    trees = numbered(seated.groupBy("key").agg(F.min("seat").alias("first"), F.count(F.lit(1)).alias("n")), "key")
    trees = trees.select(F.col("key").alias("_key"), F.col("seat").alias("tree"), "first", "n")
    leaves = seated.join(trees, F.col("key").eqNullSafe(F.col("_key"))).withColumn("at", F.col("seat") - F.col("first"))
    runs = leaves.groupBy("tree", F.floor(F.col("at") / fan).alias("up"), F.col("n").alias("leaves")).agg(F.array_sort(F.collect_list(F.struct("at", "doc_id", "leaf", "presented"))).alias("kids"))
    lone = F.col("leaves") == 1
    runs = runs.select(
        "tree", F.when(lone, 0).otherwise(1).alias("level"), F.col("up").alias("at"), F.ceil(F.col("leaves") / fan).alias("n"),
        F.when(lone, F.col("kids")[0]["leaf"]).otherwise(sha(joined(F.col("kids")["leaf"]))).alias("hash"), "kids", lone.alias("lone"),
    )
    runs = stored(runs, "merkle-runs")
    lower = levels(runs.select("tree", "level", "at", "n", "hash", F.lit(None).cast("binary").alias("children")), fan)
    groups = trees.count()
    subroots = reduce(DataFrame.unionAll, lower).filter("n = 1")
    subroots = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), F.lit(groups).cast("bigint").alias("n"), "hash", "children")
    upper = levels(stored(subroots, "merkle-subroots"), fan)[1:]

    def linked(nodes: DataFrame) -> DataFrame:
        def name(tree: Column, level: Column, at: Column) -> Column:
            return F.concat_ws(".", tree, level, F.floor(at / fan))

        inside, joins = F.col("n") > 1, (F.col("tree") != TOP) & F.lit(groups > 1)
        rank = F.when(inside, F.col("at")).when(joins, F.col("tree"))
        parent = F.when(inside, name(F.col("tree"), F.col("level") + 1, F.col("at"))).when(joins, name(F.lit(TOP), F.lit(1), F.col("tree")))
        more = [c for c in nodes.columns if c not in ("tree", "level", "at", "n", "hash")]
        subroot = F.when((F.col("n") == 1) & (F.col("tree") != TOP), F.col("hash"))
        return nodes.select(F.concat_ws(".", "tree", "level", "at").alias("node"), parent.alias("parent"), F.pmod(rank, F.lit(fan)).cast("int").alias("place"), "level", "hash", subroot.alias("subroot"), *more)

    nodes = reduce(DataFrame.unionAll, [linked(x) for x in [*lower[1:], *upper]]) if lower[1:] or upper else linked(lower[0].limit(0))
    return Manifest(linked(runs), stored(nodes, "merkle-nodes"), fan)


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, siblings, folded_root.

    siblings: the digests beside the leaf's path, level by level up to the root and left to right, joined;
    folded_root: the root that follows from the presented digest and these siblings. A lone leaf has no siblings and is its own root.
    """
    spark, fan = manifest.nodes.sparkSession, manifest.fan

    def split(place: Column) -> tuple[Column, Column]:
        return F.col("leafs").substr(F.lit(1), place * WIDTH), F.col("leafs").substr(place * WIDTH + WIDTH + 1, F.lit(fan * WIDTH))

    def fold(kid: Column, place: Column) -> Column:
        before, after = split(place)
        return F.when(F.col("lone"), kid["presented"]).otherwise(sha(F.concat(before, kid["presented"], after)))

    leaves = manifest.leaves.withColumn("leafs", joined(F.col("kids")["leaf"]))
    runs = leaves.select("node", "parent", "place", "hash", "subroot", F.transform("kids", fold).alias("folds"))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # a row per run and level, however large the table
    try:
        climbed = stored(spark.sql(CLIMB, runs=runs, nodes=manifest.nodes, width=WIDTH), "merkle-climb")
    finally:
        spark.conf.set(limit, before)
    every = leaves.select("node", "leafs", F.posexplode("kids").alias("k", "kid")).join(climbed, F.col("node") == F.col("run"))
    siblings = F.concat(*split(F.col("k")), "proof")
    digests = {"leaf": F.col("kid.leaf"), "subroot": F.col("subroot"), "root": F.col("root"), "siblings": siblings, "folded_root": F.col("folds")[F.col("k")]}
    return every.select("kid.doc_id", *[hexed(c).alias(name) for name, c in digests.items()])
