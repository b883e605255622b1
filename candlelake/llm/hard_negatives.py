"""Hard negatives by rotated one-bit codes with stored alignment.

Every vector is turned by one random rotation into more dimensions and kept as the signs there. Stored beside this
code: how far the vector reaches along its code's direction, how much of it stands across, and the
code's length. A query is turned alike and cut into bit planes, so its product with a code is
a weighted sum of popcounts, known up to what the planes round off. What a vector has across its code can
add at most the product of the two remainders' lengths (Cauchy-Schwarz), which gives an interval that
holds the true score for certain. Rows whose interval cannot matter are left out; the others are
scored on their integer components. So the intervals cost no recall: the results are those of a full scan.

All rows meet all anchors block by block: rows lie in chunks, anchors in blocks, and each pair
of a chunk and a block is one task's group of bounded size, which emits a few rows per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.common import stored

#: Code bits per dimension, bit planes of a query, rows of a chunk, fewest rows worth a chunk, anchors of a block.
BITS, PLANES, CHUNK, LEAST, BLOCK = 8, 8, 8192, 512, 2048
CODED = "row bigint, vec_id bigint, label bigint, whole binary, code binary, along double, across double, reach double"
HITS = "anchor bigint, vec_id bigint, score bigint"
FOUND = "anchor bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"
_TURNS: dict[int, np.ndarray] = {}


def rotation(size: int) -> np.ndarray:
    """Orthonormal columns: ``size`` dimensions into a multiple of 64 that is at least BITS times as many."""
    if size not in _TURNS:
        bits = -(-size * BITS // 64) * 64
        q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((bits, size)))
        _TURNS[size] = q * np.sign(np.diag(r))
    return _TURNS[size]


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes as words of 64 bits, along, across, reach): the vector is ``along`` times its code's unit direction, plus a rest of length ``across``.

    reach: length of the code brought back to the vectors' own dimensions.
    """
    turn = rotation(vectors.shape[1])
    x = vectors.astype(np.float64)
    up = x @ turn.T >= 0
    back = np.where(up, 1.0, -1.0) @ turn
    reach = np.linalg.norm(back, axis=1)
    along = np.divide((x * back).sum(1), reach, out=np.zeros(len(x)), where=reach > 0)
    across = np.sqrt(np.maximum((x * x).sum(1) - along**2, 0))
    return np.packbits(up, axis=1, bitorder="little").view(np.uint64), along, across, reach


class Query:
    """A vector cut into bit planes along the rotated axes."""

    def __init__(self, vector: np.ndarray):
        turned = rotation(len(vector)) @ vector.astype(np.float64)
        self.low = turned.min()
        self.step = (turned.max() - self.low) / ((1 << PLANES) - 1) or 1.0
        steps = np.rint((turned - self.low) / self.step).astype(np.int64)
        self.planes = np.stack([np.packbits((steps >> b & 1).astype(np.uint8), bitorder="little").view(np.uint64) for b in range(PLANES)])
        self.total, self.bits = int(steps.sum()), len(turned)
        #: Most that rounding can change in the product with a code.
        self.off = float(np.linalg.norm(turned - (self.low + self.step * steps))) * np.sqrt(len(turned))
        self.norm = float(np.linalg.norm(vector.astype(np.float64)))

    def products(self, codes: np.ndarray) -> np.ndarray:
        """Estimated products with codes of signs, from popcounts."""
        ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
        inner = np.zeros(len(codes), np.int64)
        for b in range(PLANES):
            inner += np.bitwise_count(codes & self.planes[b]).sum(1, dtype=np.int64) << b
        return self.low * (2 * ones - self.bits) + self.step * (2 * inner - self.total)

    def interval(self, codes: np.ndarray, along: np.ndarray, across: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest, highest) possible score of each row."""
        per = np.divide(1.0, reach, out=np.zeros(len(reach)), where=reach > 0)
        x, off = self.products(codes) * per, self.off * per
        rest = np.sqrt(np.maximum(self.norm**2 - np.maximum(np.abs(x) - off, 0) ** 2, 0))
        middle = along * x
        # the last part is room for the rounding of floating point
        width = np.abs(along) * off + across * rest + 1e-9 * self.norm * (np.abs(along) + across) + 1e-6
        return middle - width, middle + width


def scores(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the range of 64 bits its end."""
    if not len(rows):
        return np.empty(0, np.int64)
    bound = float(np.abs(rows.astype(np.float64)).max()) * float(np.abs(vector.astype(np.float64)).max()) * len(vector)
    if bound < 2**53:
        return (rows.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    ends = np.iinfo(np.int64)
    return np.array([min(max(s, ends.min), ends.max) for s in rows.astype(object) @ vector.astype(object)], np.int64)


def first(ids: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties by smaller id."""
    if len(score) > 4 * n:
        few = np.flatnonzero(score >= np.partition(score, -n)[-n])
        return few[np.lexsort((ids[few], -score[few]))[:n]]
    return np.lexsort((ids, -score))[:n]


def kth(values: np.ndarray, k: int) -> float:
    """The k-th highest value; below all if there are fewer."""
    return float(np.partition(values, -k)[-k]) if len(values) >= k else -np.inf


class Chunk:
    """The rows of a chunk as arrays."""

    def __init__(self, rows: pa.Table):
        def words(name: str, kind: type) -> np.ndarray:
            raw = rows.column(name).combine_chunks()
            return np.frombuffer(b"".join(raw.to_pylist()), kind).reshape(len(raw), -1)

        self.ids, self.labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        self.whole, self.codes = words("whole", np.int64), words("code", np.uint64)
        self.scales = [rows.column(c).to_numpy() for c in ("along", "across", "reach")]

    def interval(self, query: Query, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return query.interval(self.codes[some], *[x[some] for x in self.scales])


def nearest(chunk: Chunk, vec_id: int, label: int, vector: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the n best other rows of the label."""
    some = np.flatnonzero((chunk.labels == label) & (chunk.ids != vec_id))
    if len(some) > n:
        low, high = chunk.interval(Query(vector), some)
        some = some[high >= kth(low, n)]
    score = scores(chunk.whole[some], vector)
    best = first(chunk.ids[some], score, n)
    return some[best], score[best]


def between(chunk: Chunk, label: int, vector: np.ndarray, windows: list[tuple[int, int]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (lowest, highest score allowed): (places, scores) of the n best rows of other labels in it."""
    some = np.flatnonzero(chunk.labels != label)
    low, high = chunk.interval(Query(vector), some)
    wanted = np.zeros(len(some), bool)
    for least, most in windows:
        sure = kth(low[(low >= least) & (high <= most)], n)
        wanted |= (high >= max(least, sure)) & (low <= most)
    some = some[wanted]
    score = scores(chunk.whole[some], vector)
    out = []
    for least, most in windows:
        fit = np.flatnonzero((score >= least) & (score <= most))
        best = fit[first(chunk.ids[some[fit]], score[fit], n)]
        out.append((some[best], score[best]))
    return out


def coded(rows: DataFrame, vec_id: Column, label: Column, vector: Column, scale: int) -> tuple[DataFrame, int]:
    """(the usable rows with their integer components and codes, stored; number of dimensions)."""
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    given = rows.select(vec_id.cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), vector.alias("v"))
    given = given.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(finite)
    size = given.agg(F.max(F.size("v"))).first()[0] or 1
    given = given.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))

    def run(batches):
        for part in batches:
            flat, n = part.column(3), part.num_rows
            lengths = flat.value_lengths().to_numpy()
            whole = np.zeros((n, size), np.int64)
            whole[np.arange(size)[None, :] < lengths[:, None]] = flat.flatten().to_numpy()
            codes, *scales = encode(whole)
            raw = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (whole, codes)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *raw, *[pa.array(x, pa.float64()) for x in scales]], ["row", "vec_id", "label", "whole", "code", "along", "across", "reach"])

    return stored(given.mapInArrow(run, CODED), "vector-codes"), size


def hard_negatives(
    rows: DataFrame, vec_id: Column, label: Column, vector: Column, anchor: Column, positives: int = 5, negatives: int = 3,
    least: int = 50, most: int = 95, scale: int = 256, chunk: int = CHUNK, block: int = BLOCK,
) -> DataFrame:
    """For every anchor and each of its positives the hardest negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); scores are integer inner products; higher ones come first, ties by smaller vec_id.
    anchor: a condition on ``vec_id`` (named so) that says which rows are anchors. Positives are the first rows of
    the anchor's label with another vec_id; negatives the first rows of other labels whose score is from
    ``least`` to ``most`` hundredths of the positive's. Rows without vec_id, label or vector, or with a NULL or non-finite
    component, take no part. Shorter vectors are filled up with zeros, empty ones are all zeros. Rows that
    repeat an id count each; an anchor given twice is answered twice. Scores beyond 64 bits are put at their end. Empty
    tables give no rows; other columns are not read.
    """
    table, _ = coded(rows, vec_id, label, vector, scale)
    spark = rows.sparkSession
    anchors = table.filter(anchor).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "whole")
    n, n_anchors = table.count(), anchors.count()
    chunks = max(1, -(-n // chunk), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST)))
    blocks = max(1, -(-n_anchors // block))

    def place(key: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    dealt = table.select("*", place("row", chunks).alias("chunk"), every(blocks).alias("block")).drop("row").groupBy("chunk", "block")

    def search(asked: DataFrame, work, schema: str) -> DataFrame:
        meets = asked.select("*", place("anchor", blocks).alias("block"), every(chunks).alias("chunk")).groupBy("chunk", "block")
        names = [f.name for f in spark.createDataFrame([], schema).schema]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            kinds = [pa.int32() if c == "place" else pa.int64() for c in names]
            out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in names]
            if left.num_rows and right.num_rows:
                held = Chunk(left)
                for a in right.to_pylist():
                    for columns in work(held, a, np.frombuffer(a["whole"], np.int64)):
                        for o, x in zip(out, columns):
                            o.append(x)
            return pa.table([pa.array(np.concatenate(o), pa.int64()).cast(k) for o, k in zip(out, kinds)], names)

        return dealt.cogroup(meets).applyInArrow(run, schema)

    def alike(held: Chunk, a: dict, vector: np.ndarray):
        at, score = nearest(held, a["anchor_id"], a["label"], vector, positives)
        yield np.full(len(at), a["anchor"]), held.ids[at], score

    def unlike(held: Chunk, a: dict, vector: np.ndarray):
        known = sorted(a["best"], key=lambda p: p["place"])
        windows = [(-(-least * p["score"] // 100), most * p["score"] // 100) for p in known]
        for p, (at, score) in zip(known, between(held, a["label"], vector, windows, negatives)):
            m = len(at)
            yield np.full(m, a["anchor"]), np.full(m, a["anchor_id"]), np.full(m, p["place"]), np.full(m, p["vec_id"]), np.full(m, p["score"]), held.ids[at], score

    def ranked(found: DataFrame, *keys: str) -> Column:
        return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))

    best = search(anchors, alike, HITS)
    best = best.withColumn("place", ranked(best, "anchor")).filter(F.col("place") <= positives)
    best = best.groupBy("anchor").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("best"))
    asked = stored(anchors.join(best, "anchor"), "anchors")
    found = search(asked, unlike, FOUND)
    found = found.withColumn("rank", ranked(found, "anchor", "place")).filter(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
