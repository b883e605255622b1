"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded by a small network from measures of its
characters and words; gated attention weighs the passages, and the weighted sum of the encodings gives
the document's score. Encoder, attention and output learn together from document labels alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices, slices

#: Characters of a passage, hashed character pairs, and the bound of labelled documents for each label.
PASSAGE, PAIRS, PER_LABEL = 400, 96, 1200
HIDDEN, GATE, EPOCHS, BATCH, RATE = 24, 16, 30, 128, 4e-3
N_FEATURES = PAIRS + 12


def _classes() -> np.ndarray:
    """0 other, 1 space, 2 lower or uncased letter, 3 upper, 4 digit, 5 sentence sign, 6 other sign."""
    out = np.zeros(0x3000, np.uint8)
    for k in range(len(out)):
        c = chr(k)
        out[k] = 1 if c.isspace() else 3 if c.isupper() else 2 if c.isalpha() else 4 if c.isdigit() else 5 if c in ".,;:?!'\"-()" else 6 if c.isprintable() else 0
    return out


_CLASSES = _classes()


def passages(text: str, size: int = PASSAGE) -> list[str]:
    """Runs of about ``size`` characters, cut at white space where there is some; one passage at least."""
    out, start = [], 0
    while len(text) - start > size * 3 // 2:
        cut = text.rfind(" ", start + size // 2, start + size) + 1 or start + size
        out.append(text[start:cut])
        start = cut
    return [*out, text[start:]]


def excerpt(text: str) -> str:
    words = text.split()
    return " ".join(words[len(words) // 2 :][: 1 + zlib.crc32(text.encode("utf-8", "surrogatepass")) % 9])


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x N_FEATURES, passages of each text)."""
    split = [passages(t) for t in texts]
    count = np.array([len(p) for p in split], np.int64)
    flat = [p for ps in split for p in ps]
    n = len(flat)
    out = np.zeros((n, N_FEATURES), np.float32)
    code = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.array([len(p) for p in flat], np.int64)
    row = np.repeat(np.arange(n), size)
    kind = _CLASSES[np.minimum(code, len(_CLASSES) - 1)]
    total = np.maximum(size, 1)[:, None]
    out[:, :7] = np.bincount(row * 7 + kind, minlength=7 * n).reshape(n, 7) / total
    if len(code) > 1:
        same = row[1:] == row[:-1]
        # pairs of character kinds and low bits: what follows what
        pair = (code[:-1].astype(np.uint64) * np.uint64(0x9E3779B1) + code[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7)
        pair = (pair % np.uint64(PAIRS)).astype(np.int64)
        out[:, 12:] = np.sqrt(np.bincount(row[1:][same] * PAIRS + pair[same], minlength=PAIRS * n).reshape(n, PAIRS) / (total + 40)) * 2
    for k, p in enumerate(flat):
        words = p.split()
        m = len(words)
        if m:
            out[k, 7] = len(set(words)) / m
            out[k, 8] = sum(map(str.__eq__, words, words[1:])) / m
            out[k, 9] = min(len(p) / m, 30) / 10
            # words of one or two characters, and words of one sign
            out[k, 10] = sum(len(w) < 3 for w in words) / m
            out[k, 11] = sum(not w[-1].isalnum() for w in words) / m
    return out, count


class AttentionBags:
    """p = sigmoid(c . sum_k a_k h_k + d), a = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k))), h = tanh(E x + e)."""

    def __init__(self, seed: int = 0):
        g = np.random.default_rng(seed)
        s = lambda a, b: g.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {"E": s(N_FEATURES, HIDDEN), "e": np.zeros(HIDDEN), "V": s(HIDDEN, GATE), "U": s(HIDDEN, GATE), "w": s(GATE, 1)[:, 0], "c": s(HIDDEN, 1)[:, 0], "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def forward(self, x: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
        p, at = self.p, np.cumsum(count) - count
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * s) @ p["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, at), count))
        a /= np.repeat(np.add.reduceat(a, at), count)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "y": y}

    def gradients(self, x: np.ndarray, count: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f, at = self.p, self.forward(x, count), np.cumsum(count) - count
        dy = weight * (f["y"] - truth) / weight.sum()
        dz = np.repeat(dy[:, None] * p["c"], count, axis=0)
        da = (dz * f["h"]).sum(1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, at), count))
        gate = ds[:, None] * p["w"]
        dt, du = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
        return {"E": f["x"].T @ dh, "e": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ du, "w": (f["t"] * f["s"]).T @ ds, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], truth: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> AttentionBags:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-2
        g, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = g.permutation(len(bags))
            for k in range(0, len(order), BATCH):
                pick = order[k : k + BATCH]
                grads = self.gradients(np.concatenate([bags[i] for i in pick]), np.array([len(bags[i]) for i in pick]), truth[pick], weight[pick])
                step += 1
                for name, grad in grads.items():
                    grad = grad + 1e-4 * self.p[name]
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v[name] = 0.99 * v[name] + 0.01 * grad**2
                    self.p[name] = self.p[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.forward(x, count)["y"]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id", label: str = "quality", per_label: int = PER_LABEL):
    """The model, from at most ``2 * per_label`` labelled documents drawn by a hash of the id; or the share of label 1.

    ``learn`` is a condition on the labels' id column. Weights restore the labels' true shares.
    Conflicting labels of one id: the smaller one counts. Labels other than 0 and 1, or of NULL ids, are ignored.
    """
    known = labels.filter(learn).select(F.col(f"`{doc_id}`").alias("l_id"), F.col(f"`{label}`").cast("int").alias("l_y"))
    known = known.filter(F.col("l_id").isNotNull() & F.col("l_y").isin(0, 1)).groupBy("l_id").agg(F.min("l_y").alias("l_y"))
    held = {r["l_y"]: r["count"] for r in known.groupBy("l_y").count().collect()}
    if len(held) < 2:
        return float(held.get(1, 0)) / sum(held.values()) if held else 0.5
    share = F.when(F.col("l_y") == 1, min(1.0, per_label / held[1])).otherwise(min(1.0, per_label / held[0]))
    drawn = known.filter(F.pmod(F.xxhash64("l_id"), F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.xxhash64("l_id")).limit(2 * per_label)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("l_id")).select("text", "l_id", "l_y")  # at most 2 * per_label rows

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(0).to_pylist()
        # a few words from the middle as well, so that very short texts are known ground
        x, count = features(texts + [excerpt(t) for t in texts])
        ends = np.cumsum(count)
        raw = [x[e - c : e].astype("<f2").tobytes() for e, c in zip(ends, count)]
        twice = pa.array([*range(len(texts))] * 2)
        return pa.RecordBatch.from_arrays([part.column(1).take(twice), part.column(2).take(twice), pa.array(raw, pa.binary())], ["id", "y", "bag"])

    got = sorted(map_slices(rows, "text", "id bigint, y int, bag binary", work).collect())
    if len({r["y"] for r in got}) < 2:
        return float(held[1]) / sum(held.values())
    truth = np.array([r["y"] for r in got], float)
    seen = {y: (truth == y).sum() for y in (0, 1)}
    weight = np.where(truth == 1, held[1] / seen[1], held[0] / seen[0])
    return AttentionBags().fit([np.frombuffer(r["bag"], "<f2").reshape(-1, N_FEATURES).astype(np.float64) for r in got], truth, weight / weight.mean())


def scored(model: AttentionBags | float, texts: pa.Array) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    return model.score(*features(pc.fill_null(texts, "").to_pylist())) if len(texts) else np.empty(0)


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, held_out: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= 0.5).

    Only the text is an input of a score. NULL and empty texts are one empty passage and get its
    score. Without labels of both kinds every score is the share of label 1 (0.5 without labels).
    Repeated rows are scored each; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, text, doc_id))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        y = scored(shared.value, part.column(2))
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(y), pa.array((y >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text}`").alias("text"))
    return map_slices(rows, "text", "doc_id bigint, held_out boolean, score double, predicted int", work, 4_000_000)


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, text, doc_id))
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in slices([batch], place, 4_000_000):
                yield part.filter(pa.array(scored(shared.value, part.column(place)) >= least))

    return docs.mapInArrow(run, docs.schema)
