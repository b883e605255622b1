import hashlib
import random
import sys
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from candlelake.llm.bpe import PrefixTable, Slots, bpe_decode, bpe_edit, bpe_encode, coder, prefix_tables
from candlelake.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SIGNS = ["a", "b", "the", " the", "'s", "'", "'re", "r", "e", " ", "  ", "\n", "\t", "\xa0", " ", "\x1c", "\x85", "1", "23", "é", "é", "日本", "Привет", "🙂", "!!", "...", "<|endoftext|>", "aaaa", "​"]


@pytest.fixture(scope="module")
def own():
    return coder(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.words.ranks, special_tokens={})


def encode(own, texts):
    flat, starts = own.encode(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


def test_every_character_as_the_library(own, library):
    texts = [f"a{chr(k)} {chr(k)}b{chr(k)}{chr(k)}" for k in range(sys.maxunicode + 1) if not 0xD800 <= k < 0xE000 and (k < 0x3400 or k % 11 == 0)]
    assert encode(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_random_texts_as_the_library(own, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choice("aeh nt") for _ in range(rng.randint(1, 200))) for _ in range(300)] + ["x" * 300, "ab" * 99, "", None]
    assert encode(own, texts) == [library.encode_ordinary(t or "") for t in texts]


def test_neighbours_agree_as_defined(own):
    words, rng = own.words, np.random.default_rng(1)
    # pairs that meet, near misses of them and random ones
    some = [words.merged("".join(rng.choice(list("aehinorst"), 12)).encode()) for _ in range(1500)]
    pairs = [(words.ranks[a], words.ranks[b]) for parts in some for a, b in zip(parts, parts[1:])]
    pairs += [(a, d) for (a, _), (_, d) in zip(pairs, pairs[7:])] + [tuple(x) for x in rng.integers(0, len(words.tokens), (5000, 2)).tolist()]
    want = [words.merged(words.tokens[a] + words.tokens[b]) == [words.tokens[a], words.tokens[b]] for a, b in pairs]
    a, b = np.array(pairs).T
    assert words._agree(a, b).tolist() == want and words.agree(a, b).tolist() == want and words.agree(a, b).tolist() == want
    assert [words.agrees(x, y) for x, y in pairs] == want
    assert 0 < sum(want) < len(want)


def test_last_token_of_every_prefix(own):
    words, rng = own.words, random.Random(2)
    for _ in range(60):
        piece = "".join(rng.choice("aehinrst日é") for _ in range(rng.randint(1, 20))).encode()
        last, n = words.prefixes(piece)
        assert n == len(piece)
        assert last == [words.ranks[words.merged(piece[: k + 1])[-1]] for k in range(len(piece))]


def test_appends_and_edits(own, library):
    rng = random.Random(4)
    for _ in range(150):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 25)))
        table = PrefixTable.of(own, text)
        for _ in range(6):
            a = rng.randint(0, len(table.text))
            b = rng.choice([a, min(len(table.text), a + rng.randint(0, 6))])
            put = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 4)))
            table = table.append(put) if rng.random() < 0.3 else table.edit(a, b, put)
            fresh = PrefixTable.of(own, table.text)
            assert (table.last, table.firsts) == (fresh.last, fresh.firsts)
            assert table.ids() == library.encode_ordinary(table.text)
            again = PrefixTable.load(own, table.text, table.raw())
            assert (again.last, again.firsts) == (table.last, table.firsts)


def test_edits_compute_little(own, library):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("aehinrst") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    table = PrefixTable.of(own, text)
    for k in (0, 7000, len(text) - 1):
        new = table.edit(k, k + 1, "q")
        assert new.computed < 40 and new.ids() == library.encode_ordinary(new.text)
    word = PrefixTable.of(own, "".join(rng.choice("aehinrst") for _ in range(5000)))
    new = word.edit(2000, 2001, "zz")
    assert new.computed < 400 and new.ids() == library.encode_ordinary(new.text)
    assert new.append("e").computed < 5


def test_whole_tables(spark, docs, rows, no_docs, library):
    got = bpe_decode(bpe_encode(docs, PATH, PATTERN), PATH).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows]
    order = lambda x: (x[0] is None, x[0] or 0, x[2])
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=order) == sorted(want, key=order)
    both = bpe_encode(docs, PATH, PATTERN, decode=True).collect()
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in both), key=order) == sorted(want, key=order)
    assert bpe_encode(no_docs, PATH, PATTERN).count() == 0 == bpe_decode(bpe_encode(no_docs, PATH, PATTERN), PATH).count()


def test_unknown_ids(spark):
    given = spark.createDataFrame([(1, [1, 2]), (2, [1, 10**9]), (3, [-1]), (4, None), (5, []), (6, [None])], "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe_decode(given, PATH).collect()}
    assert got[1] and all(got[k] is None for k in (2, 3, 6)) and bytes(got[4]) == bytes(got[5]) == b""


def test_edits_of_a_table(spark, docs, rows, no_docs, library):
    tables = prefix_tables(docs.filter("doc_id < 40 or doc_id is null"), PATH, PATTERN)
    edits = spark.createDataFrame([(20, 5, 9, "new words"), (7, None, None, " tail"), (2, 0, 0, "x"), (22, 90, 10, None), (999, 0, 0, "?"), (None, 0, 1, "?")], "doc_id bigint, start bigint, stop bigint, put string")
    got = {r["doc_id"]: r for r in bpe_edit(tables, edits, PATH, PATTERN).collect() if r["doc_id"] is not None}
    text = {i: t or "" for i, t, *_ in rows}
    want = text | {20: text[20][:5] + "new words" + text[20][9:], 7: text[7] + " tail", 2: "x"}
    assert {i: r["text"] for i, r in got.items()} == {i: want[i] for i in got}
    assert all(r["ids"] == library.encode_ordinary(r["text"]) for r in got.values())
    assert bpe_edit(prefix_tables(no_docs, PATH, PATTERN), edits, PATH, PATTERN).count() == 0


def test_a_very_long_word(own, library):
    rng = random.Random(6)
    word = "".join(rng.choice("aehinrst") for _ in range(100_000))
    began = time.time()
    assert encode(own, [word, "x" * 100_000])[0] == library.encode_ordinary(word)
    assert time.time() - began < 30


def test_slots():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 50, 5000))
    table = Slots(keys, np.arange(len(keys)), -7)
    assert (table[keys] == np.arange(len(keys))).all() and (table[np.setdiff1d(keys + 1, keys)] == -7).all()


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode()))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op12_byte_bpe"](spark, sf).collect()}
    assert got == want
