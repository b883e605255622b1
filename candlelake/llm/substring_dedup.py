"""Substring dedup with prefix-partitioned suffix trees over words.

A suffix matters only if its first ``window`` words start in two documents. Suffixes are dealt out by a
prefix of a few words that both copies of such a repeat are bound to choose alike: the word run with
the smallest hash inside the window. Consecutive suffixes choose the same run, so they travel together
with their words as one stretch.

1. Count: prefixes that only one document holds have no repeats; they go before any text moves.
2. Equal stretches of several documents are settled by their smallest id; one of them stands for all.
3. The stretches that stand for others meet by prefix, in groups sized for memory. Each group builds
   the top of its suffix tree by prefix doubling: suffixes that agree on 1, 2, 4, ... words, down to
   the nodes at the depth of a window. All suffixes below such a node share a window, and those of
   larger documents than its smallest are repeats.
4. A prefix with too many stretches for a task is lengthened to the whole window. Its subtrees are then
   single nodes, of which only the smallest id is wanted, and an ordinary aggregate finds that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices, stored
from candlelake.llm.shingles import mix, rolled, word_hashes, word_spans

#: Words of a repeat and of the first prefix; stretches of a group; words that a task handles at a time.
WINDOW, PREFIX, GROUP, WORDS_AT_ONCE = 50, 8, 4096, 2_000_000


def smallest_places(value: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value among every ``width`` consecutive ones, by doubling."""
    place, low, done = np.arange(len(value)), value, 1
    while done < width:
        step = min(done, width - done)
        left, right = low[:-step], low[step:]
        first = left <= right
        place = np.where(first, place[:-step], place[step:])
        low = np.where(first, left, right)
        done += step
    return place


def stretches(words: np.ndarray, first: np.ndarray, window: int, prefix: int) -> dict[str, np.ndarray]:
    """Runs of windows that choose the same prefix: text, start (word in its text), runs on by more windows, place of the prefix, hashes."""
    n = len(words) - window + 1
    if n <= 0:
        return {k: np.empty(0, np.int64) for k in ("text", "start", "more", "place", "anchor", "context")}
    gram = rolled(words, prefix)
    chosen = smallest_places(gram, window - prefix + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    valid = text[:n] == text[window - 1 :]
    change = np.append(True, (chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1]) | (text[1:n] != text[: n - 1]))
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], n) - 1  # last window of a run
    keep = valid[begin]
    begin, end = begin[keep], end[keep]
    # hash of the whole stretch and of the prefix's place in it, from sums over all words
    powers = np.cumprod(np.append(np.uint64(1), np.full(len(words), np.uint64(0x9E3779B97F4A7C15 | 1))))
    back = np.cumprod(np.append(np.uint64(1), np.full(len(words), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64)))))
    total = np.append(np.uint64(0), np.cumsum(mix(words) * powers[:-1]))
    place = chosen[begin] - begin
    context = mix((total[end + window] - total[begin]) * back[begin] + ((end - begin) * (window - prefix + 1) + place).astype(np.uint64))
    return {"text": text[begin], "start": begin - first[text[begin]], "more": end - begin, "place": place, "anchor": gram[chosen[begin]], "context": context}


def equal_windows(flat: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all windows inside runs of ``size`` words, node of each): equal nodes for equal windows, by prefix doubling."""
    run = np.repeat(np.arange(len(size)), size)
    rank = np.unique(flat, return_inverse=True)[1].astype(np.int64)
    depth, where = 1, np.arange(len(flat))
    while depth < window:
        step = min(depth, window - depth)
        # a suffix has ``depth + step`` words if its run goes on so long
        fits = where[where + depth + step <= len(flat)]
        fits = fits[run[fits] == run[fits + depth + step - 1]]
        pair = rank[fits] * np.int64(len(flat) + 1) + rank[fits + step]
        rank = np.zeros(len(flat), np.int64)
        rank[fits] = np.unique(pair, return_inverse=True)[1]
        depth, where = depth + step, fits
    return where, rank[where]


def _grouped(batches: Iterator[pa.RecordBatch], key: str, words: str, limit: int) -> Iterator[pa.Table]:
    """Batches sorted by ``key`` put together to whole groups of at least ``limit`` words."""
    held: list[pa.Table] = []
    count = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(pa.Table.from_batches([b]))
        count += b.column(b.schema.get_field_index(words)).nbytes // 8
        if count >= limit:
            t = pa.concat_tables(held).combine_chunks()
            k = t.column(key).to_numpy()
            other = np.flatnonzero(k != k[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield t.slice(0, cut)
            held = [t.slice(cut)]
            count = held[0].column(words).nbytes // 8 if cut else count // 2
    if held:
        yield pa.concat_tables(held).combine_chunks()


def repeated_words(size: int, starts: np.ndarray, more: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` words some run of repeated windows covers."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + more + window, size), -1)
    return np.cumsum(step[:-1]) > 0


def substring_dedup(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id", prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged. A word goes if a run of
    ``window`` words that covers it also starts in a document with a smaller id, judged on the input;
    kept_text is the other words joined by one space (NULL where nothing goes), kept_sha256 its hash.
    NULL and empty texts have no words. Rows without an id remove nothing and lose nothing; rows that
    share an id do not remove each other's words. An empty table gives no rows; other columns are not
    read. Words are compared by 64-bit hashes, a window by all of its words.
    """
    prefix = min(prefix, window)
    span = window - prefix + 1  # a stretch has at most so many windows; its first one's place and the others' number are kept in one number
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    named = rows.filter("doc_id is not null")

    def light(part: pa.RecordBatch) -> pa.RecordBatch:
        s = stretches(*word_hashes(part.column(2), lower=False), window, prefix)
        at = pa.array(s["text"])
        return pa.RecordBatch.from_arrays(
            [pa.array(s["anchor"].astype(np.int64)), pa.array(s["context"].astype(np.int64)), part.column(0).take(at), part.column(1).take(at), pa.array(s["start"] * span + s["more"])],
            ["anchor", "context", "doc_id", "row", "pos"],
        )

    every = map_slices(named, "text", "anchor bigint, context bigint, doc_id bigint, row bigint, pos bigint", light, 2_000_000)
    shared = every.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low <> high").select("anchor")
    # aggregates are stored before they are joined: then both sides of a join are plain shuffles, whose hot keys Spark splits
    met = stored(every.join(stored(shared, "shared"), "anchor"), "met")
    same = stored(met.groupBy("anchor", "context").agg(F.min("doc_id").alias("first")), "same")
    crowd = stored(same.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "crowd")
    # 0: repeats all of its windows; 1 and 2: meets other stretches, in a tree or in single nodes
    kind = F.when(F.col("doc_id") > F.col("first"), 0).when(F.col("n") == 1, None).when(F.col("n") <= group, 1).otherwise(2)
    known = met.join(same.join(crowd, "anchor"), ["anchor", "context"]).select("doc_id", "row", "anchor", "pos", kind.alias("kind")).filter("kind is not null")
    per_row = known.groupBy("row").agg(F.collect_list(F.struct("kind", "pos", "anchor")).alias("runs"))
    held = stored(named.join(per_row, "row"), "held")  # whole texts, of documents with something to settle only

    def words_of(part: pa.RecordBatch):
        """Stretches of kind 1 and 2 of a slice: (row in the slice, kind, anchor, start, words)."""
        words, first = word_hashes(part.column(1), lower=False)
        runs = part.column(3)
        flat, at = runs.flatten(), np.repeat(np.arange(part.num_rows), pc.list_value_length(runs).to_numpy(zero_copy_only=False))
        kinds, pos, anchor = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        use = kinds > 0
        at, kinds, pos, anchor = at[use], kinds[use], pos[use].astype(np.int64), anchor[use]
        start, size = pos // span, pos % span + window
        begin = first[at] + start
        every_word = words[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        return at, kinds, anchor, start, size, every_word

    def stretch_rows(part: pa.RecordBatch) -> pa.RecordBatch:
        at, kinds, anchor, start, size, words = words_of(part)
        raw, ends = words.tobytes(), np.cumsum(size) * 8
        use = np.flatnonzero(kinds == 1)
        cut = pa.array([raw[e - s * 8 : e] for e, s in zip(ends[use].tolist(), size[use].tolist())], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(anchor[use]), part.column(2).take(pa.array(at[use])), part.column(0).take(pa.array(at[use])), pa.array(start[use]), cut], ["anchor", "doc_id", "row", "start", "words"])

    def node_rows(part: pa.RecordBatch) -> pa.RecordBatch:
        at, kinds, anchor, start, size, words = words_of(part)
        node = rolled(words, window)
        count = size - window + 1
        run = np.repeat(np.arange(len(size)), count)
        k = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        use = kinds[run] == 2
        run, k = run[use], k[use]
        node = node[(np.cumsum(size) - size)[run] + k]
        rows_of = pa.array(at[run])
        return pa.RecordBatch.from_arrays([pa.array(anchor[run]), pa.array(node.astype(np.int64)), part.column(2).take(rows_of), part.column(0).take(rows_of), pa.array(start[run] + k)], ["anchor", "node", "doc_id", "row", "start"])

    def trees(batches):
        for t in _grouped(batches, "anchor", "words", WORDS_AT_ONCE):
            raw = t.column("words").combine_chunks()
            size = pc.binary_length(raw).to_numpy().astype(np.int64) // 8
            flat = np.frombuffer(b"".join(raw.to_pylist()), np.uint64)
            where, node = equal_windows(flat, size, window)
            run = np.repeat(np.arange(len(size)), size)[where]
            doc = t.column("doc_id").to_numpy()[run]
            low = np.full(int(node.max()) + 1 if len(node) else 0, np.iinfo(np.int64).max)
            np.minimum.at(low, node, doc)
            hit = doc > low[node]
            run, start = run[hit], t.column("start").to_numpy()[run[hit]] + where[hit] - (np.cumsum(size) - size)[run[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(t.column("row").to_numpy()[run]), pa.array(start)], ["row", "start"])

    texts = held.select("row", "text", "doc_id", "runs")
    ordered = map_slices(texts, "text", "anchor bigint, doc_id bigint, row bigint, start bigint, words binary", stretch_rows, 2_000_000)
    repeats = ordered.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(trees, "row bigint, start bigint")
    nodes = map_slices(texts.filter(F.exists("runs", lambda r: r["kind"] == 2)), "text", "anchor bigint, node bigint, doc_id bigint, row bigint, start bigint", node_rows, 2_000_000)
    lows = nodes.groupBy("anchor", "node").agg(F.min("doc_id").alias("first"))
    crowded = nodes.join(lows, ["anchor", "node"]).filter("doc_id > first").select("row", "start")
    found = repeats.unionAll(crowded).groupBy("row").agg(F.collect_set("start").alias("starts"))

    def cut_out(part: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, first = word_spans(part.column(1))
        raw, out = data.tobytes(), []
        for k in range(part.num_rows):
            a, b = int(first[k]), int(first[k + 1])
            own = [(r["pos"] // span, r["pos"] % span) for r in part.column(3)[k].as_py() if r["kind"] == 0]
            at = np.array([x for x, _ in own] + (part.column(4)[k].as_py() or []), np.int64)
            more = np.zeros(len(at), np.int64)
            more[: len(own)] = [m for _, m in own]
            gone = repeated_words(b - a, at, more, window)
            kept = b" ".join([raw[x:y] for x, y in zip(starts[a:b][~gone].tolist(), ends[a:b][~gone].tolist())])
            out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2])], ["row", "n_removed", "sha", "kept_text"])

    changed = map_slices(
        held.select("row", "text", "doc_id", "runs").dropDuplicates(["row"]).join(found, "row", "left"), "text", "row bigint, n_removed bigint, sha string, kept_text string", cut_out, 2_000_000
    ).filter("n_removed > 0")

    def whole(part: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, first = word_spans(part.column(2))
        raw = data.tobytes()
        spans = list(zip(starts.tolist(), ends.tolist()))
        sha = [hashlib.sha256(b" ".join([raw[x:y] for x, y in spans[a:b]])).hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(first)), pa.array(sha)], ["doc_id", "row", "n_words", "whole"])

    base = map_slices(rows, "text", "doc_id bigint, row bigint, n_words bigint, whole string", whole, 2_000_000)
    return base.join(changed, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"), "kept_text"
    )
