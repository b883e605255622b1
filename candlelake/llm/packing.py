"""Best-two-fit packing of documents into sequences of bounded length.

The plan is made on the histogram of piece lengths (at most ``capacity`` rows, whatever the input):
bins are filled greedily with the longest piece that still fits; then a bin's smallest piece is put
back if two unpacked pieces fill its gap more tightly. Equal bins are planned once, with their number,
so the plan has a few thousand lines for any number of documents. Pieces then find their place by
their rank among the pieces of one length; ranks are counted in buckets by a hash of the id, so that a
length that a third of all pieces share is ranked in many tasks. Full pieces need no plan and no rank.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices, stored
from candlelake.llm.tokens import encoder

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pieces of at most ``capacity`` ids (a text's ids, then ``end_id``); of a cut document only the first may be shorter."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = encoder(tokenizer).encode(part.column(1))
        n = len(offsets) - 1
        size = np.diff(offsets) + 1
        flat = np.empty(len(ids) + n, "<u4")
        ends = np.cumsum(size)
        mask = np.ones(len(flat), bool)
        mask[ends - 1] = False
        flat[ends - 1] = end_id
        flat[mask] = ids
        pieces = -(-size // capacity)
        row = np.repeat(np.arange(n), pieces)
        k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = size - (pieces - 1) * capacity
        start = np.where(k == 0, 0, first[row] + (k - 1) * capacity)
        length = np.where(k == 0, first[row], capacity)
        raw, at = memoryview(flat).cast("B"), ((ends - size)[row] + start) * 4
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())]
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(row)), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return map_slices(rows, "text", PIECE_SCHEMA, work)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins), from the number of pieces of each length."""
    left = np.zeros(capacity + 2, np.int64)
    for size, n in histogram.items():
        left[size] = n
    plan: list[tuple[list[int], int]] = []
    while (there := np.flatnonzero(left)).size:
        bin_: list[int] = []
        free, taken = capacity, np.zeros_like(left)

        def longest(limit: int) -> int:
            k = int(np.searchsorted(there, limit, side="right"))
            while k > 0 and left[there[k - 1]] <= taken[there[k - 1]]:
                k -= 1
            return int(there[k - 1]) if k else 0

        while free > 0 and (x := longest(free)):
            bin_.append(x)
            taken[x] += 1
            free -= x
        if free and len(bin_) > 1:
            # two unpacked pieces instead of the smallest one, if they leave a smaller gap
            small, best = bin_[-1], (0, 0)
            taken[small] -= 1
            room = free + small
            open_ = there[(there < room) & (left[there] > taken[there])]
            lo, hi = 0, len(open_) - 1
            while lo <= hi:
                a, b = int(open_[lo]), int(open_[hi])
                if a + b > room or (lo == hi and left[a] - taken[a] < 2):
                    hi -= 1
                else:
                    if a + b > sum(best):
                        best = (a, b)
                    lo += 1
            new = best if sum(best) > small else (small,)
            bin_[-1:] = new
            for x in new:
                taken[x] += 1
        used = np.flatnonzero(taken)
        times = int((left[used] // taken[used]).min())
        left[used] -= times * taken[used]
        plan.append((bin_, times))
    return plan


def best_fit_packing(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, text: str = "text", doc_id: str = "doc_id", buckets: int = 64
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are cut. NULL and
    empty texts give one piece with ``end_id`` alone. Repeated rows and rows without an id are packed
    like others (rows with equal ids can swap places). An empty table gives no rows; other columns
    are not read. ``tokenizer`` is a path that every executor can open.
    """
    spark = docs.sparkSession
    pieces = stored(cut_pieces(docs, tokenizer, capacity, end_id, text, doc_id), "pieces")
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    # a full piece is a sequence of its own
    full = pieces.filter(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    pieces = pieces.filter(F.col("length") < capacity)
    counts = pieces.groupBy("length", bucket.alias("bucket")).count()
    # at most capacity x buckets rows
    held = counts.toPandas().sort_values(["length", "bucket"])
    plan = plan_bins({int(k): int(v) for k, v in held.groupby("length")["count"].sum().items()}, capacity)
    held["before"] = held.groupby("length")["count"].cumsum() - held["count"]
    before = np.zeros((capacity + 1, buckets), np.int64)
    before[held["length"], held["bucket"]] = held["before"]

    # for each length: the first rank, the first sequence, and the offset of every run of equal slots
    runs: dict[int, list[tuple[int, int, int]]] = {}
    filled = dict.fromkeys(held["length"].tolist(), 0)
    sequence = 0
    for bin_, times in plan:
        offset = 0
        for x in bin_:
            runs.setdefault(x, []).append((filled[x], sequence, offset))
            filled[x] += times
            offset += x
        sequence += times
    tables = {x: np.array(r, np.int64) for x, r in runs.items()}
    shared = spark.sparkContext.broadcast((before, tables))

    def place(parts):
        first, lines = shared.value
        for pdf in parts:
            rank = pdf["rank"].to_numpy() - 1 + first[pdf["length"].to_numpy(), pdf["bucket"].to_numpy()]
            seq, off = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
            for x, at in pdf.groupby("length").indices.items():
                t = lines[x]
                k = np.searchsorted(t[:, 0], rank[at], side="right") - 1
                seq[at] = t[k, 1] + rank[at] - t[k, 0]
                off[at] = t[k, 2]
            yield pd.DataFrame({**{c: pdf[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}, "sequence_id": seq, "offset": off})

    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(order))
    return full.unionByName(ranked.mapInPandas(place, PIECE_SCHEMA + ", sequence_id bigint, offset bigint"))
