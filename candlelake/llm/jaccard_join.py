"""N-gram Jaccard join by MinHash banding.

Texts with the same set of word shingles are one member with several copies. Members meet in the
buckets where one of their bands agrees; the number of bands and of rows in a band follow from the recall wanted
at the threshold. A bucket never yields its pairs:

1. Each member of a bucket is verified against the bucket's smallest, on full shingle sets and in linear
   work. Verified ties make first classes; unverified ones make nothing, so chance meetings chain no groups.
2. Only buckets that still hold several first classes are looked at again, block against block, and only
   across classes. What leaves a task is a spanning forest of the classes that its links join.
3. Where links are counted, the members of a first class are compared block against block as well. A
   task emits a count per member, never pairs.

Classes alone (one_of_each) need no third step: there, a large group of near copies costs linear work.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices, stored
from candlelake.llm.components import components
from candlelake.llm.shingles import mix, shingle_sets

#: Words of a shingle, threshold, recall wanted at the threshold, rows of a band.
WORDS, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.999, 5
#: Members and shingles of a block.
BLOCK, BLOCK_SHINGLES = 256, 400_000
LINKS = "node bigint, other bigint, links bigint"
TIES = "a bigint, low bigint"


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Fewest bands of ``rows`` rows with which a pair at the threshold meets with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def sketch(docs: DataFrame, words: int, bands: int, rows: int, text: str, doc_id: str) -> DataFrame:
    """doc_id, n (distinct shingles), k1 and k2 (128 bits of the set), bands."""
    g = np.random.default_rng(7)
    a = g.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = g.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    step = g.integers(1, 1 << 63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for s in shingle_sets(part.column(1), words):
            low = np.full(bands * rows, ~np.uint64(0))
            for k in range(0, len(s), 4096):
                low = np.minimum(low, (s[k : k + 4096, None] * a + b).min(0))
            key = mix((mix(low).reshape(bands, rows) * step).sum(1))
            out.append((len(s), int(s.sum().astype(np.int64)), int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().astype(np.int64)), key.astype(np.int64) if len(s) else None))
        n, k1, k2, keys = zip(*out)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "k1", "k2", "bands"]
        )

    rows_ = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_slices(rows_, "text", "doc_id bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>", work, 2_000_000)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sorted sets."""
    every = np.concatenate([*left, *right])
    value, place = np.unique(every, return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    out = np.zeros((len(left), len(right)), np.float32)
    # shingles of one member alone meet nothing
    often = np.bincount(place, minlength=len(value)) > 1
    column = np.cumsum(often) - 1
    row, column = row[often[place]], column[place[often[place]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for k in range(0, int(often.sum()), 4096):
        a, b = np.searchsorted(column, [k, k + 4096])
        x = np.zeros((len(left) + len(right), 4096), np.float32)
        x[row[a:b], column[a:b] - k] = 1
        out += x[: len(left)] @ x[len(left) :].T
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links (indices) that keep apart components together, at most n - 1."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
            if len(out) == n - 1:
                break
    return out


def is_linked(both: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    n, m = (np.array([len(s) for s in x], np.float64) for x in (left, right))
    return both >= similarity * (n[:, None] + m[None, :] - both) - 1e-9


def counted(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes with links, number of links) of the linked pairs of places a and b."""
    links = np.bincount(np.concatenate([a, b]), minlength=len(nodes))
    return nodes[links > 0], links[links > 0]


class Meeting:
    """Sketches, members, and the buckets in which members meet; tables in the shared work folder."""

    def __init__(self, docs: DataFrame, words: int, similarity: float, recall: float, rows: int, text: str, doc_id: str, block: int, block_shingles: int):
        self.words, self.similarity, self.block, self.block_shingles = words, similarity, block, block_shingles
        self.sketches = stored(sketch(docs, words, bands_for(similarity, recall, rows), rows, text, doc_id), "sketch")
        self.full = self.sketches.filter("doc_id is not null and n > 0")
        copies = self.full.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "bands")).alias("low"))
        self.members = stored(copies.select("k1", "k2", "n", F.col("low.doc_id").alias("copy_of"), F.col("low.bands").alias("bands")), "members")
        met = self.members.select(F.col("copy_of").alias("node"), "n", F.posexplode("bands").alias("band", "key"))
        # of buckets with the same members the one of the first band stays
        every = met.groupBy("band", "key").agg(
            F.min(F.struct("node", "n")).alias("low"), F.count(F.lit(1)).alias("here"), F.bit_xor(F.xxhash64("node")).alias("s1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2")
        )
        kept = every.filter("here > 1").groupBy("low", "here", "s1", "s2").agg(F.min(F.struct("band", "key")).alias("b"))
        kept = kept.select("b.band", "b.key", F.col("low.node").alias("low"), F.col("low.n").alias("n_low"))
        self.met = stored(met.join(kept, ["band", "key"]), "buckets")
        wanted = self.members.select(F.col("copy_of").alias("node"), "bands").join(self.met.select("node").distinct(), "node")
        texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("node"), F.col(f"`{text}`").alias("text")).join(wanted, "node")

        def sets(part: pa.RecordBatch) -> pa.RecordBatch:
            raw = pa.array([s.tobytes() for s in shingle_sets(part.column(1), words)], pa.binary())
            return pa.RecordBatch.from_arrays([part.column(0), part.column(2), raw], ["node", "bands", "set"])

        self.sets = stored(map_slices(texts, "text", "node bigint, bands array<bigint>, set binary", sets, 2_000_000), "sets")

    def parts(self, count: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(count / self.block), F.ceil(shingles / self.block_shingles)).cast("int")

    def first_classes(self) -> DataFrame:
        """(node, label) of the members that a verified tie joins to another; label is the smallest of them."""
        similarity = self.similarity
        # sets of very different sizes cannot be similar
        near = (F.col("n") >= similarity * F.col("n_low") - 1e-6) & (F.col("n_low") >= similarity * F.col("n") - 1e-6)
        ties = self.met.filter((F.col("node") != F.col("low")) & near).select("node", "n", "low").distinct()
        heads = ties.groupBy(F.col("low").alias("head")).agg(self.parts(F.count(F.lit(1)), F.sum("n")).alias("parts"))
        tied = ties.join(heads, F.col("low") == F.col("head")).select("low", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
        heads = heads.select(F.col("head").alias("low"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("head").alias("node"))
        sent = tied.unionAll(heads).join(self.sets.select("node", "set"), "node")

        def star(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.drop_duplicates("node")
            held = {n: np.frombuffer(s, np.uint64) for n, s in zip(pdf["node"], pdf["set"])}
            head, out = held.pop(key[0]), []
            for n, s in held.items():
                both = np.isin(s, head, assume_unique=True).sum()
                if both >= similarity * (len(s) + len(head) - both) - 1e-9:
                    out.append(n)
            return pd.DataFrame({"a": np.array(out, "int64"), "low": np.full(len(out), key[0], "int64")})

        found = stored(sent.groupBy("low", "part").applyInPandas(star, TIES), "ties")
        # one tie a member; its others tie the heads to each other
        first = found.groupBy(F.col("a").alias("node")).agg(F.min("low").alias("head"))
        more = found.join(first, F.col("a") == F.col("node")).filter(F.col("low") != F.col("head")).select(F.col("head").alias("a"), F.col("low").alias("b")).distinct()
        return components(first.select(F.col("node").alias("a"), F.col("head").alias("b")).unionAll(more))

    def across(self, classes: DataFrame) -> DataFrame:
        """LINKS across first classes: (node, node, links) counts them, (label, label, 0) joins two classes."""
        similarity = self.similarity
        labels = classes.withColumnsRenamed({"node": "_node", "label": "_label"})
        named = self.met.join(labels, F.col("node") == F.col("_node"), "left").select("band", "key", "node", "n", F.coalesce("_label", "node").alias("label"))
        by_label = named.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
        # classes that fill blocks have blocks of their own, the others share some
        big = (F.col("c") >= self.block) | (F.col("s") >= self.block_shingles)
        mixed = by_label.groupBy("band", "key").agg(F.count(F.lit(1)).alias("labels"), F.sum(F.when(~big, F.col("c"))).alias("few"), F.sum(F.when(~big, F.col("s"))).alias("few_s"))
        mixed = mixed.filter("labels > 1").drop("labels")
        large = by_label.filter(big).select("band", "key", "label", "c", "s")
        dealt = named.join(mixed, ["band", "key"]).join(large, ["band", "key", "label"], "left")
        own = F.col("c").isNotNull()
        parts = F.when(own, self.parts(F.col("c"), F.col("s"))).otherwise(self.parts(F.col("few"), F.col("few_s")))
        k = F.pmod(F.xxhash64("node"), parts)
        dealt = dealt.select("band", "key", "node", "label", F.when(own, F.col("label")).alias("alone"), F.when(own, F.concat_ws(":", "label", k)).otherwise(F.concat_ws(":", F.lit("few"), k)).alias("own"))
        dealt = stored(dealt, "mixed")
        blocks = dealt.select("band", "key", F.col("own").alias("other"), F.col("alone").alias("other_alone")).distinct()
        sent = dealt.join(blocks, ["band", "key"]).filter("alone is null or other_alone is null or alone <> other_alone")
        sent = sent.select("band", "key", "node", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(self.sets, "node")

        def cross(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            band, _, i, j = key
            pdf = pdf.drop_duplicates("node").sort_values(["own", "node"])
            sides = [pdf[pdf["own"] == x] for x in ([i] if i == j else [i, j])]
            held = [[np.frombuffer(s, np.uint64) for s in x["set"]] for x in sides]
            a = b = np.empty(0, np.int64)
            pdf = pd.concat(sides)
            nodes, labels = pdf["node"].to_numpy(), pdf["label"].to_numpy()
            if held[0] and held[-1]:
                linked = is_linked(shared_counts(held[0], held[-1]), held[0], held[-1], similarity)
                a, b = np.nonzero(np.triu(linked, 1) if i == j else linked)
                b = b if i == j else b + len(held[0])
                differ = labels[a] != labels[b]
                a, b = a[differ], b[differ]
            names, place = np.unique(labels, return_inverse=True)
            tree = forest(len(names), place[a], place[b])
            # a pair that meets in several buckets counts in the first
            keys = np.stack(pdf["bands"].to_list()) if len(a) else np.empty((0, 1))
            once = np.array([(keys[x] == keys[y]).argmax() == band for x, y in zip(a.tolist(), b.tolist())], bool)
            some, links = counted(nodes, a[once], b[once])
            return pd.DataFrame({
                "node": np.concatenate([some, [names[x] for x, _ in tree]]).astype("int64"),
                "other": np.concatenate([some, [names[y] for _, y in tree]]).astype("int64"),
                "links": np.concatenate([links, np.zeros(len(tree))]).astype("int64"),
            })

        return stored(sent.groupBy("band", "key", "i", "j").applyInPandas(cross, LINKS), "across")

    def inside(self, classes: DataFrame) -> DataFrame:
        """LINKS inside first classes: (node, node, links)."""
        similarity = self.similarity
        sizes = self.members.select("copy_of", "n").join(classes, F.col("copy_of") == F.col("node")).select("node", "label", "n")
        cut = sizes.groupBy("label").agg(self.parts(F.count(F.lit(1)), F.sum("n")).alias("blocks"))
        placed = sizes.join(cut, "label").select("node", "label", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"))
        # block i meets block j, i <= j
        sent = placed.select("node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        sent = sent.select("node", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(self.sets.select("node", "set"), "node")

        def verify(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            _, i, j = key
            pdf = pdf.drop_duplicates("node").sort_values("node")
            sides = [pdf[pdf["own"] == x] for x in ([i] if i == j else [i, j])]
            held = [[np.frombuffer(s, np.uint64) for s in x["set"]] for x in sides]
            nodes, a, b = np.concatenate([x["node"].to_numpy() for x in sides]), np.empty(0, np.int64), np.empty(0, np.int64)
            if held[0] and held[-1]:
                linked = is_linked(shared_counts(held[0], held[-1]), held[0], held[-1], similarity)
                a, b = np.nonzero(np.triu(linked, 1) if i == j else linked)
                b = b if i == j else b + len(held[0])
            some, links = counted(nodes, a, b)
            return pd.DataFrame({"node": some, "other": some, "links": links}).astype("int64")

        return sent.groupBy("label", "i", "j").applyInPandas(verify, LINKS)

    def classes(self, count: bool) -> DataFrame:
        """doc_id, class_id, copy_of and, if counted, n_links; one row per row of the sketches."""
        first = self.first_classes()
        links = self.across(first)
        joined = components(links.filter("links = 0").select(F.col("node").alias("a"), F.col("other").alias("b")))
        joined = joined.withColumnsRenamed({"node": "_label", "label": "_class"})
        first = first.withColumnsRenamed({"node": "_node", "label": "_first"})
        known = self.members.join(first, F.col("copy_of") == F.col("_node"), "left").withColumn("_first", F.coalesce("_first", "copy_of"))
        known = known.join(joined, F.col("_first") == F.col("_label"), "left").select("k1", "k2", "n", "copy_of", F.coalesce("_class", "_first").alias("class_id"))
        counts, no_counts = ["n_links"] if count else [], [F.lit(0).cast("bigint").alias("n_links")] if count else []
        if count:
            every = links.filter("links > 0").unionAll(self.inside(first.withColumnsRenamed({"_node": "node", "_first": "label"})))
            every = every.groupBy("node").agg(F.sum("links").alias("_links"))
            known = known.join(every, F.col("copy_of") == F.col("node"), "left").select("k1", "k2", "n", "copy_of", "class_id", F.coalesce("_links", F.lit(0)).alias("n_links"))
        out = self.full.select("doc_id", "k1", "k2", "n").join(known, ["k1", "k2", "n"]).select("doc_id", "class_id", "copy_of", *counts)
        rest = self.sketches.filter("doc_id is null or n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), *no_counts)
        return out.unionAll(rest)


def similar_classes(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id",
    block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """jaccard_join() without n_links, which spares the comparisons inside classes."""
    return Meeting(docs, words, similarity, recall, rows, text, doc_id, block, block_shingles).classes(False)


def jaccard_join(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id",
    block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, copy_of, n_links.

    Two texts are linked if the Jaccard similarity of their shingle sets (``words`` words, A-Z in lower
    case, split at 0x20 and 0x09-0x0D; a shorter text is one shingle) is at least ``similarity``.
    copy_of: smallest id with the same set; n_links: how many other sets this one is linked to (copies
    are not counted again); class_id: smallest id that a chain of links leads to. A pair at the
    threshold is met with probability ``recall``, a closer one with a higher one. NULL and empty texts
    have no shingles and are linked to nothing, not even to each other. Rows without an id are left
    out of the join: their other columns are NULL and n_links 0. Rows that share an id but not the text count as
    one node. Texts of any length are taken whole. An empty table gives no rows; other columns are not read.
    """
    return Meeting(docs, words, similarity, recall, rows, text, doc_id, block, block_shingles).classes(True)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all their columns; rows without an id stay."""
    gone = similar_classes(docs, doc_id=doc_id, **options).filter("doc_id <> class_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(f"`{doc_id}`") == F.col("_gone"), "left_anti")
