"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (lengths 1 to 3) that both hold, over the
geometric mean of the numbers that each holds: the blended-spectrum presence kernel, normalised. It is
approximated by Nystrom landmarks, and a kernel ridge regression per language (one versus rest) is
fitted on the landmark features of a bounded sample. Presence is a 0/1 row of hashed n-grams, so the
kernel with all landmarks and the regression are one matrix product per block of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices

#: Hashed n-grams; bounds of the sample: texts for each language, and landmarks: in all, and more where a language would have fewer than MARKS.
WIDTH, PER_LANGUAGE, LANDMARKS, MARKS, RIDGE = 1 << 14, 250, 200, 8, 1e-2
BLOCK = 512
_SHIFT = np.uint64(64 - 14)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(k).isalpha() for k in range(0x110000)]))
    return _LETTERS[0]


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x WIDTH of 0/1, whether the text has a letter). Runs without letters count as one space."""
    out = np.zeros((len(texts), WIDTH), np.uint8)
    some = np.zeros(len(texts), bool)
    letters = _letters()
    for k, text in enumerate(texts):
        code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letters[code]
        some[k] = is_letter.any()
        code = np.where(is_letter, code, 32)
        code = code[np.append(True, is_letter[1:] | is_letter[:-1])].astype(np.uint64)
        gram = code + np.uint64(1)
        row = out[k]
        row[(gram * _MIX) >> _SHIFT] = 1
        for n in (1, 2):
            gram = gram[:-1] * np.uint64(0x110001) + code[n:] + np.uint64(1)
            row[(gram * _MIX) >> _SHIFT] = 1
    return out, some


def normed(bits: np.ndarray) -> np.ndarray:
    """Rows of presence over the root of their number of n-grams, so that products of rows are kernels."""
    x = bits.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


class KernelRidge:
    """One-versus-rest ridge regression on Nystrom features of the presence kernel."""

    def __init__(self, languages: list[str], rows: np.ndarray, truth: np.ndarray, landmarks: int | None = None, ridge: float = RIDGE):
        self.languages = languages
        landmarks = landmarks or max(LANDMARKS, MARKS * len(languages))
        # every language has its share of the landmarks
        order = np.argsort([np.sum(truth[:k] == t) for k, t in enumerate(truth)], kind="stable")
        marks = normed(rows[order[:landmarks]]).astype(np.float64)
        values, vectors = np.linalg.eigh(marks @ marks.T)
        good = values > 1e-8 * values.max()
        whiten = vectors[:, good] / np.sqrt(values[good])
        # in blocks: the sample stays one byte a place
        feature = np.concatenate([normed(rows[k : k + BLOCK]) @ marks.T for k in range(0, len(rows), BLOCK)]) @ whiten
        feature = np.hstack([feature, np.ones((len(rows), 1))])
        target = np.where(truth[:, None] == np.arange(len(languages)), 1.0, -1.0)
        share = np.array([(truth == t).sum() for t in truth], float)
        weight = len(truth) / (len(languages) * share)
        left = feature.T @ (feature * weight[:, None]) + ridge * len(rows) / landmarks * np.eye(feature.shape[1])
        solved = np.linalg.solve(left, feature.T @ (target * weight[:, None]))
        self.bias = solved[-1].astype(np.float32)
        # landmarks, whitening and regression in one matrix: n-grams x languages
        self.matrix = (marks.T @ (whiten @ solved[:-1])).astype(np.float32)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Rows x languages, each row adding up to 1."""
        out = np.empty((len(rows), len(self.languages)))
        for k in range(0, len(rows), BLOCK):
            out[k : k + BLOCK] = normed(rows[k : k + BLOCK]) @ self.matrix + self.bias
        out = np.exp(4 * (out - out.max(1, keepdims=True)))
        return out / out.sum(1, keepdims=True)


def fit(train: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> KernelRidge | None:
    """Fits on about ``per_language`` texts of each language, drawn by a hash of the text.

    Copies of a text count once, in the draw too. Rows with a NULL text or language, or without a letter, teach
    nothing; None if there are none. The languages are taken to be few (their counts are collected).
    """
    rows = train.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("text"))
    # texts, not rows: copies collapse below
    held = {r["lang"]: r["count"] for r in rows.filter(F.col("text").rlike(r"\p{L}")).select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not held:
        return None
    languages = sorted(held)
    draw = F.pmod("h", F.lit(1 << 30))
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(int(min(1.0, 1.5 * per_language / held[k]) * (1 << 30))))])
    drawn = rows.filter(draw < share[F.col("lang")]).select("text", "lang", "h")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        bits, some = presence(part.column(0).to_pylist())
        out = pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())], ["lang", "h", "bits"])
        return out.filter(pa.array(some))

    sample = map_slices(drawn, "text", "lang string, h bigint, bits binary", work).distinct().orderBy("h", "lang").limit(2 * per_language * len(languages)).collect()
    if not sample:
        return None
    bits = np.unpackbits(np.frombuffer(b"".join(r["bits"] for r in sample), np.uint8).reshape(len(sample), -1), axis=1)
    return KernelRidge(languages, bits, np.array([languages.index(r["lang"]) for r in sample]))


def language_id(docs: DataFrame, learn: Column, held_out: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    ``learn`` marks the rows to learn from, ``held_out`` is passed on. NULL texts and texts without a
    letter are "und" with score 0, and so are all if there is nothing to learn from. Repeated rows are
    scored each; NULL ids are kept; an empty table gives no rows; other columns are not read.
    """
    model = fit(docs.filter(learn), text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        bits, some = presence(pc.fill_null(part.column(2), "").to_pylist())
        if m is None:
            names, best = ["und"] * len(some), np.zeros(len(some))
        else:
            scores = m.scores(bits)
            at = scores.argmax(1)
            names = [m.languages[k] if ok else "und" for k, ok in zip(at, some)]
            best = np.where(some, scores.max(1), 0.0)
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(best)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text}`").alias("text"))
    return map_slices(rows, "text", "doc_id bigint, held_out boolean, lang_pred string, score double", work, 2_000_000)
