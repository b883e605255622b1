import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from candlelake.llm.packing import best_fit_packing, plan_bins
from candlelake.llm.token_counts import token_counts
from candlelake.llm.tokens import UnitEncoder, encoder
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("fast", [True, False])
def test_units_give_the_library_s_ids(fast):
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", " ", "　", "<|endoftext|>", "<|endof", "'s", "'S", "12", "!?", "é", "é", "\x0b", "\x1c", "日本", "👍🏽", " x", " foo", "Don't", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, "", " ", "x" * 3000]
    own = UnitEncoder(PATH)
    assert own.fast is not None
    if not fast:
        own.fast = None
    ids, at = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [ids_of(t) for t in texts]


def test_long_texts_with_runs_of_white_space_are_cut():
    """Cuts stay out of runs of white space, so that only short units are encoded; a text that holds the mark is not cut."""
    own, seen = UnitEncoder(PATH), []
    whole = own.whole
    own.whole = lambda texts: seen.extend(map(len, texts)) or whole(texts)
    rng = random.Random(4)
    text = "".join(rng.choice(["word", " ", "  ", "a b", "\n ", " \n", "\u3000 ", " <|endoftext|> ", "x. ", "\t\t "]) for _ in range(5000))
    texts = [text, "  " + text, text + " ", "a  b\U0010ffff c", "\U0010ffff  ", "   "]
    ids, at = own.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [ids_of(t) for t in texts]
    assert max(seen) < 200


def test_counts_against_the_library(docs, rows):
    got = sorted((tuple(r) for r in token_counts(docs, PATH, limit=50).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 50) for i, t in rows), key=str)


def test_counts_with_sentencepiece(docs, rows):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((r["n_tokens"] for r in token_counts(docs, path).collect()))
    assert got == sorted(len(model.encode(t or "")) for _, t in rows)


def test_counts_in_word_scheme(docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = sorted(r["n_tokens"] for r in token_counts(docs, path).collect())
    assert got == sorted(len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in rows)


def test_small_slices_change_nothing(docs):
    assert sorted(token_counts(docs, PATH, slice_bytes=10).collect(), key=str) == sorted(token_counts(docs, PATH).collect(), key=str)


def test_packing_is_whole_and_gapless(docs, rows):
    capacity = 100
    got = best_fit_packing(docs, PATH, capacity=capacity, buckets=3).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        if r["doc_id"] is not None:
            by_doc.setdefault(r["doc_id"], []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    for i, t in rows:
        if i in (None, 5):
            continue
        ids = [*ids_of(t), 2]
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert all(r["length"] == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            raw = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(raw))
            at += r["length"]
        assert at == len(ids)
    total = sum(len(ids_of(t)) + 1 for _, t in rows)
    assert sum(r["length"] for r in got) == total
    assert len(by_sequence) <= total / capacity * 1.15 + 1


def test_two_pieces_replace_the_smallest():
    # 60 + 30 leaves a gap of 10; 22 + 18 instead of 30 leaves none
    plan = plan_bins({60: 1, 30: 1, 22: 1, 18: 1}, 100)
    assert (sorted(plan[0][0]), plan[0][1]) == ([18, 22, 60], 1)
    assert sum(n for _, n in plan) == 2


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    histogram = {k: rng.randint(1, 10**9) for k in rng.sample(range(1, 1024), 400)}
    plan = plan_bins(histogram, 1024)
    used = {}
    for sizes, n in plan:
        assert sum(sizes) <= 1024
        for x in sizes:
            used[x] = used.get(x, 0) + n
    assert used == histogram
    assert len(plan) < 5000


def test_empty(no_docs):
    assert token_counts(no_docs, PATH).count() == 0
    assert best_fit_packing(no_docs, PATH).count() == 0


def test_one_encoder_per_worker():
    assert encoder(PATH) is encoder(PATH)
