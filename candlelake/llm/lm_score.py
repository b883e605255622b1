"""Language-model scores: marginal likelihood over a subword lattice.

The model writes a text as a run of pieces of an existing vocabulary, drawn independently; a word
starts with a space. A word's probability is the sum over all its segmentations, from a log-space
forward recursion over its bytes. Words of the learning texts also have an edge of their own from
start to end: its weight is the word's count less an absolute discount, and what the discount frees
weighs the segmentations into pieces. Piece probabilities start from the order of the vocabulary's own
scores and are re-estimated by expectation-maximisation over all distinct words of the learning texts,
since the pieces serve words as words come new, not as often as they recur.

Everything a word needs is computed once per distinct word: its count and its two log-probabilities.
Texts then fetch these by a join on the word. The most frequent words (a bounded table) are broadcast and
summed where the text is read, so that no hot word is shuffled; all others go through a shuffle join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import lower_ascii, map_slices, stored

#: Words that are broadcast (of at most so many characters), rounds of re-estimation, and the pseudo-count of a piece.
FREQUENT, FREQUENT_CHARS, ROUNDS, PSEUDO = 50_000, 64, 3, 0.05
#: Words that a task handles at a time.
BATCH = 60_000
BASE = np.uint64(0x100000001B3)
TABLE_BITS = 21


class Pieces:
    """The vocabulary as byte strings, with a hash table that finds many substrings at once."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[bytes, int] = {}
        for k in range(model.get_piece_size()):
            if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                continue
            name = model.id_to_piece(k)
            piece = bytes([int(name[3:5], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode()
            # a space can only start a word, and no text holds A-Z
            if piece and b" " not in piece[1:] and not any(65 <= b <= 90 for b in piece) and piece not in found:
                found[piece] = k
        for b in range(256):
            found.setdefault(bytes([b]), 1 << 30)
        self.names = sorted(found, key=found.get)
        #: Log-probabilities: at first by rank, as the vocabulary orders them by score.
        start = 1 / (np.arange(len(self.names)) + 10.0)
        self.logp = np.log(start / start.sum())
        self.longest = max(map(len, self.names))
        self.code = np.array([int(self.hashed(np.frombuffer(p, np.uint8)[None, :])[0]) for p in self.names], np.uint64)
        for mix in np.random.default_rng(0).integers(1, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1):
            at = (self.code * mix) >> np.uint64(64 - TABLE_BITS)
            if np.unique(at, return_counts=True)[1].max() <= 2:
                break
        self.mix, self.first, self.second = mix, np.full(1 << TABLE_BITS, -1, np.int32), np.full(1 << TABLE_BITS, -1, np.int32)
        for k, a in enumerate(at):
            (self.second if self.first[a] >= 0 else self.first)[a] = k

    @staticmethod
    def hashed(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            out = out * BASE + rows[:, k].astype(np.uint64) + np.uint64(1)
        return out

    def find(self, code: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where there is none."""
        at = (code * self.mix) >> np.uint64(64 - TABLE_BITS)
        got = self.first[at]
        miss = (got >= 0) & (self.code[got] != code)
        if miss.any():
            other = self.second[at[miss]]
            got[miss] = np.where((other >= 0) & (self.code[other] == code[miss]), other, -1)
        return got


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def lattice(p: Pieces, logp: np.ndarray, words: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Words of one length as rows of bytes (space first): their log-probabilities, and expected piece counts if weighted."""
    n, length = words.shape
    prefix = np.zeros((length + 1, n), np.uint64)
    for k in range(length):
        prefix[k + 1] = prefix[k] * BASE + words[:, k].astype(np.uint64) + np.uint64(1)
    power = np.cumprod(np.append(np.uint64(1), np.full(p.longest, BASE)))
    forward = np.full((length + 1, n), -np.inf)
    forward[0] = 0
    edges = []
    for end in range(1, length + 1):
        arrived = forward[end]
        for size in range(1, min(end, p.longest) + 1):
            start = end - size
            got = p.find(prefix[end] - prefix[start] * power[size])
            at = np.flatnonzero(got >= 0)
            if not len(at):
                continue
            got = got[at]
            arrived[at] = np.logaddexp(arrived[at], forward[start, at] + logp[got])
            if weight is not None:
                edges.append((start, end, at, got))
    if weight is None:
        return forward[length], None
    backward = np.full((length + 1, n), -np.inf)
    backward[length] = 0
    expected = np.zeros(len(p.names))
    for start, end, at, got in reversed(edges):
        onward = logp[got] + backward[end, at]
        backward[start, at] = np.logaddexp(backward[start, at], onward)
        expected += np.bincount(got, weight[at] * np.exp(forward[start, at] + onward - forward[length, at]), len(expected))
    return forward[length], expected


def word_rows(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows of bytes with the leading space) for each byte length among the words."""
    raw = [b" " + w.encode() for w in words.to_pylist()]
    size = np.array([len(w) for w in raw], np.int64)
    order = np.argsort(size, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(at):
            yield at, np.frombuffer(b"".join([raw[k] for k in at.tolist()]), np.uint8).reshape(len(at), -1)


def gathered(batches: Iterable[pa.RecordBatch], rows: int = BATCH) -> Iterator[pa.Table]:
    """Arrow batches put together to about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if any(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks()


def estimate(vocabulary: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log-probabilities of the pieces, by EM over all distinct words with c > 0."""
    spark = vocabulary.sparkSession
    p = pieces(path)
    logp = p.logp
    learning = vocabulary.filter("c > 0").select("word")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(logp)

        def work(batches):
            own = pieces(path)
            total = np.zeros(len(own.names))
            for t in gathered(batches):
                for _, rows in word_rows(t.column(0).combine_chunks()):
                    total += lattice(own, shared.value, rows, np.ones(len(rows)))[1]
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["piece", "n"])

        # one row for each piece of the vocabulary at most
        got = learning.mapInArrow(work, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        count = np.full(len(p.names), PSEUDO)
        for r in got:
            count[r["piece"]] += r["n"]
        logp = np.log(count / count.sum())
    return logp


def lm_scores(docs: DataFrame, vocabulary: str, learn: Column, held_out: Column, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words between white space (0x20, 0x09-0x0D) of the text with A-Z in lower case, and
    one end. base_score: log10 with add-half smoothing of token counts; score: log10 of the lattice
    model. NULL texts are empty (the end alone). ``learn`` marks the rows whose counts are used; with
    none the pieces keep their first probabilities, an end has probability 1/2 and train_tokens is 0.
    Repeated rows are scored each (and counted each); NULL ids are kept; an empty table gives no rows;
    other columns are not read. ``vocabulary`` is a .model file that every executor can open.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), held_out.alias("held_out"), learn.alias("learn"), lower_ascii(body).alias("text"))
    words = rows.select("learn", F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("word")).filter("word <> ''")

    counted = stored(words.groupBy("word").agg(F.coalesce(F.sum(F.col("learn").cast("bigint")), F.lit(0)).cast("bigint").alias("c")), "words")
    ends = rows.filter("learn").count()
    often = [F.sum(x.cast("bigint")).alias(a) for a, x in (("v", F.col("c") > 0), ("n1", F.col("c") == 1), ("n2", F.col("c") == 2))]
    total = counted.agg(F.sum("c").alias("n"), *often).first()
    n, v = int(total["n"] or 0) + ends, int(total["v"] or 0) + (ends > 0)
    logp = estimate(counted, vocabulary, rounds) if n else pieces(vocabulary).logp
    n1, n2 = total["n1"] or 0, total["n2"] or 0
    discount = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
    freed = discount * v / n if n else 1.0
    shared = docs.sparkSession.sparkContext.broadcast(logp)

    def work(batches):
        own = pieces(vocabulary)
        for t in gathered(batches):
            out = np.empty(t.num_rows)
            for at, bytes_ in word_rows(t.column(0).combine_chunks()):
                out[at] = lattice(own, shared.value, bytes_)[0] + np.log(freed)
            c = t.column(1).to_numpy()
            whole = np.log(np.maximum(c - discount, 1e-300) / max(n, 1))
            out = np.where(c > 0, np.logaddexp(out, whole), out)
            yield pa.RecordBatch.from_arrays([t.column(0).combine_chunks(), t.column(1).combine_chunks(), pa.array(out / np.log(10))], ["word", "c", "lp"])

    def base(c: Column) -> Column:
        return F.log10((c + 0.5) / (n + 0.5 * (v + 1)))

    scored = stored(counted.mapInArrow(work, "word string, c bigint, lp double"), "scored")
    table = scored.select(F.col("word").alias("w"), "lp", (F.col("c") > 0).cast("bigint").alias("known"), base(F.col("c")).alias("base"), "c")
    # words that occur 2^k times or more, with the least k that leaves at most FREQUENT of them
    short = table.filter((F.length("w") <= FREQUENT_CHARS) & (F.col("c") > 0))
    octaves = {r["k"]: r["count"] for r in short.groupBy(F.floor(F.log2("c")).alias("k")).count().collect()}  # 64 rows at most
    least = next((k for k in range(64) if sum(m for o, m in octaves.items() if o >= k) <= FREQUENT), 64)
    hot = short.filter(F.floor(F.log2("c")) >= least)
    near = docs.sparkSession.sparkContext.broadcast({r["w"].encode(): (r["lp"], r["known"], r["base"]) for r in hot.collect()})
    last = (float(np.log10((ends - discount) / n if ends else freed / 2)), int(ends > 0), float(np.log10((ends + 0.5) / (n + 0.5 * (v + 1)))))

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        """Of each text one row with its sums over the end and the frequent words, and one row for each other word."""
        known, at, word, n_, sums = near.value, [], [], [], []
        for k, body in enumerate(part.column(3).to_pylist()):
            lp, seen, bs = last
            tokens = 1
            for w, c in Counter(body.encode().split()).items():
                hit = known.get(w)
                if hit is None:
                    at.append(k)
                    word.append(w)
                    n_.append(c)
                    sums.append(None)
                else:
                    lp, seen, bs, tokens = lp + c * hit[0], seen + c * hit[1], bs + c * hit[2], tokens + c
            at.append(k)
            word.append(b" %d" % k)  # no word: words hold no space
            n_.append(tokens)
            sums.append((lp, seen, bs))
        place = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [*[part.column(c).take(place) for c in range(3)], pa.array(word, pa.string()), pa.array(n_, pa.int64())]
            + [pa.array([x and x[c] for x in sums], t) for c, t in enumerate((pa.float64(), pa.int64(), pa.float64()))],
            ["doc_id", "held_out", "h", "word", "n", "lp0", "known0", "base0"],
        )

    texts = rows.select("doc_id", "held_out", F.xxhash64("text").alias("h"), "text")
    each = map_slices(texts, "text", "doc_id bigint, held_out boolean, h bigint, word string, n bigint, lp0 double, known0 bigint, base0 double", count, 4_000_000)
    met = each.join(table, F.col("word") == F.col("w"), "left")

    def total_of(own: str, rare: str) -> Column:
        return F.sum(F.coalesce(F.col(own), F.col("n") * F.col(rare)))

    sums = met.groupBy("doc_id", "held_out", "h").agg(
        F.count("lp0").alias("rows"), F.sum("n").alias("n"), total_of("known0", "known").alias("known"), total_of("base0", "base").alias("base"), total_of("lp0", "lp").alias("lp")
    )
    rows_of = F.col("rows")
    return sums.select(
        "doc_id",
        "held_out",
        (F.col("n") / rows_of).cast("bigint").alias("n_tokens"),
        (F.col("known") / rows_of).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") / rows_of).alias("base_score"),
        (F.col("lp") / rows_of).alias("score"),
        F.explode(F.sequence(F.lit(1), rows_of)).alias("_row"),
    ).drop("_row")
