import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from candlelake.llm import html_extract as H
from candlelake.llm import langid, quality
from candlelake.llm import lm_score as L
from candlelake.llm.common import fold
from candlelake.llm.queries import op2_quality, op6_html_extraction, op10_language_id
from llm_tables import make_docs
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def fold_of(i, n):
    return zlib.crc32(str(i).encode()) % n


# language id


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op10_language_id(spark, SF).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (fold_of(r["doc_id"], 4) == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_id_edges(spark, docs, no_docs):
    yes = F.lit(True)
    taught = docs.withColumn("lang", F.when(F.col("doc_id") >= 100, F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")))
    got = {r["doc_id"]: r for r in langid.language_id(taught, yes, F.lit(False)).collect()}
    assert {got[i]["lang_pred"] for i in (1, 2, 3)} == {"und"} and got[1]["score"] == 0
    assert got[40]["lang_pred"] in ("aa", "bb")
    nothing = langid.language_id(docs, yes, F.lit(False)).collect()  # every lang is NULL
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == docs.count()
    assert langid.language_id(no_docs, yes, yes).count() == 0


def test_language_id_learns_under_heavy_copies(spark, monkeypatch):
    """Copies do not take the places of a language's other texts."""
    texts = [(f"aa words of text number {chr(97 + k // 26)}{chr(97 + k % 26)}{chr(97 + k % 7)}", "aa") for k in range(600)] + [("one and the same", "aa")] * 20000
    texts += [(f"bb zeilen {chr(97 + k // 26)}{chr(97 + k % 26)}", "bb") for k in range(100) for _ in range(50)]
    texts += [(f"cc {chr(97 + k // 26)}{chr(97 + k % 26)}", "cc") for k in range(20)] + [(str(k), "cc") for k in range(4000)]
    seen = {}

    class Seen(langid.KernelRidge):
        def __init__(self, languages, rows, truth, **options):
            seen.update({k: int((truth == i).sum()) for i, k in enumerate(languages)})

    monkeypatch.setattr(langid, "KernelRidge", Seen)
    langid.fit(spark.createDataFrame(texts, "text string, lang string").repartition(4))
    assert 250 <= seen["aa"] <= 500 and seen["bb"] == 100 and seen["cc"] == 20


def test_every_one_of_many_languages_has_landmarks():
    """More languages than landmarks by default: each still has its own, and is told from the others."""
    rng = np.random.default_rng(5)
    names = [f"l{k:03d}" for k in range(230)]
    letters = [rng.choice([chr(c) for c in range(0x4E00, 0x4E00 + 2000)], 12) for _ in names]
    say = lambda k: "".join(rng.choice(letters[k], 40))
    rows = langid.presence([say(k) for k in range(230) for _ in range(6)])[0]
    model = langid.KernelRidge(names, rows, np.repeat(np.arange(230), 6))
    got = model.scores(langid.presence([say(k) for k in range(230)])[0]).argmax(1)
    assert (got == np.arange(230)).mean() > 0.97


def test_presence_kernel_against_sets():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc dé1") for _ in range(rng.randint(0, 12))) for _ in range(40)]
    bits, some = langid.presence(texts)

    def grams(t):
        s = f" {''.join(c if c.isalpha() else ' ' for c in t.lower())} "
        while "  " in s:
            s = s.replace("  ", " ")
        return {s[k : k + n] for n in (1, 2, 3) for k in range(len(s) - n + 1)}

    sets = [grams(t) for t in texts]
    want = np.array([[len(a & b) for b in sets] for a in sets])
    got = bits.astype(int) @ bits.astype(int).T
    assert np.abs(got - want).max() <= 2  # hashed n-grams may meet
    assert some.tolist() == [any(c.isalpha() for c in t) for t in texts]


# quality


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = op2_quality(spark, SF).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (fold_of(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.96


def test_quality_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(100, 1), (101, 1), (None, 0), (102, None), (103, 7)], "doc_id bigint, quality int")
    got = quality.quality_scores(docs, labels, F.lit(True), F.lit(False)).collect()
    assert {r["score"] for r in got} == {1.0} and len(got) == docs.count()  # one kind of label only
    none = quality.quality_scores(docs, labels.limit(0), F.lit(True), F.lit(False)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(no_docs, labels, F.lit(True), F.lit(False)).count() == 0
    both = spark.createDataFrame([(100 + k, k % 2) for k in range(40)] + [(100, 1)], "doc_id bigint, quality int")
    kept = quality.keep_good(docs, both, F.lit(True))
    scores = quality.quality_scores(docs, both, F.lit(True), F.lit(False))
    assert kept.schema == docs.schema and kept.count() == scores.filter("predicted = 1").count()


def test_attention_gradients():
    """The analytic gradients against differences."""
    rng = np.random.default_rng(3)
    model = quality.AttentionBags()
    count = np.array([1, 4, 2])
    x, truth, weight = rng.normal(size=(7, quality.N_FEATURES)), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        y = model.forward(x, count)["y"]
        return -(weight * (truth * np.log(y) + (1 - truth) * np.log(1 - y))).sum() / weight.sum()

    grads = model.gradients(x, count, truth, weight)
    for name, value in model.p.items():
        at = tuple(rng.integers(0, n) for n in value.shape)
        keep = value[at]
        value[at] = keep + 1e-6
        up = loss()
        value[at] = keep - 1e-6
        down = loss()
        value[at] = keep
        assert grads[name][at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_passages_are_the_whole_text():
    text = "word " * 1000 + "x" * 2000
    assert "".join(quality.passages(text)) == text and quality.passages("") == [""]


# language model


def brute_lattice(p, logp, word):
    raw = b" " + word.encode()
    index = {n: k for k, n in enumerate(p.names)}
    total = [1.0] + [0.0] * len(raw)
    for end in range(1, len(raw) + 1):
        for start in range(end):
            if raw[start:end] in index:
                total[end] += total[start] * math.exp(logp[index[raw[start:end]]])
    return math.log(total[-1])


def test_lattice_sums_all_segmentations():
    p = L.pieces(PIECES)
    words = ["the", "a", "unbelievable", "über", "日本", "x" * 30, "\x00"]
    for at, rows in L.word_rows(pa.array(words)):
        got, expected = L.lattice(p, p.logp, rows, np.ones(len(rows)))
        for k, place in enumerate(at):
            assert got[k] == pytest.approx(brute_lattice(p, p.logp, words[place]), rel=1e-9)
        # expected pieces cover every byte once
        assert (expected * np.array([len(n) for n in p.names])).sum() == pytest.approx(rows.size)


def test_scores_against_brute_force(spark, rows):
    learn = lambda i: fold_of(i, 5) != 1
    every = [r for r in rows if r[0] is not None]
    docs = make_docs(spark, every)
    rest = fold(F.col("doc_id"), 5)
    got = L.lm_scores(docs, PIECES, rest != 1, rest == 1, rounds=1).collect()
    tokens = [(i, [w.decode() for w in (t or "").encode().lower().split()] + [None]) for i, t in every]
    counts = {}
    for i, ws in tokens:
        if learn(i):
            for w in ws:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, not learn(i), len(ws), sum(w in counts for w in ws), n, round(sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens)
    assert sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_scores_prefer_the_learnt(spark, rows):
    words = [w for _, t in rows if t for w in t.split()][:4000]
    rng = random.Random(2)
    taught = [(k, " ".join(rng.choice(words) for _ in range(50))) for k in range(40)]
    asked = [(1000, taught[0][1]), (1001, " ".join("qx" + "".join(rng.choice("zkjv") for _ in range(6)) for _ in range(50)))]
    got = {r["doc_id"]: r["score"] for r in L.lm_scores(make_docs(spark, taught + asked), PIECES, F.col("doc_id") < 1000, F.col("doc_id") >= 1000, rounds=1).collect()}
    assert got[1000] > got[1001]


def test_lm_without_learning_and_empty(spark, docs, no_docs):
    got = L.lm_scores(docs, PIECES, F.lit(False), F.lit(True), rounds=1).collect()
    assert len(got) == docs.count() and {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}
    assert L.lm_scores(no_docs, PIECES, F.lit(True), F.lit(True), rounds=1).count() == 0


# pages


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><script>var t="</p>";</script><!-- no <p>x</p> -->
    <p>One &amp; two<br>three <b>bold<p>Next &eacute;<a href="x>y">link</a></div><ul><li>a<li>b</ul><div hidden>no</div><textarea>no</textarea>tail &am"""
    got = H.blocks(page)
    assert [b[1] for b in got] == ["One & two three bold", "Next élink", "a", "b", "tail &am"]
    assert H.blocks("") == [] and H.blocks("plain  text") == [((), "plain text", 0)]
    assert [b[1] for b in H.blocks("a<script>never closed <p>x")] == ["a"]


def test_blocks_keep_text_after_odd_tags():
    def texts(page):
        return [b[1] for b in H.blocks(page)]

    for tag in ("<svg viewBox='0 0 1 1'/>", "<svg/>", "<math />", "<video/>", "<object>", "<button>", "<select>", "<video src=x>"):
        assert texts(f"<p>one</p>{tag}<p>two</p>") == ["one", "two"], tag
    assert texts("<p>one</p><svg/><p>two</p><svg>no</svg><p>three") == ["one", "two", "three"]
    assert texts("<svg a=b/>no</svg><button>no</button><p>one") == ["one"]
    for names in ("class='story hidden lg:block'", "title='The hidden valley'", "title=\"it is display: none\"", "title=it's", "class=a\"", "class='a'\"", "data-x=\"aria-hidden=true\""):
        assert texts(f"<p {names}>one</p><p>two</p>") == ["one", "two"], names
    for names in ("hidden", "HIDDEN=''", "class=a hidden", "style='color:red; display : none'", "aria-hidden=\"true\"", "aria-hidden=true", "id='x'hidden"):
        assert texts(f"<div {names}>no</div><p>two</p>") == ["two"], names
    assert texts("<a title='x>y' alt = \"a>b\">link</a>") == ["link"]


def test_extraction_on_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op6_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    want = {i: "\n\n".join(b[1] for b in H.blocks(p) if H.weak_label(b[0]) == 1) for i, p in pages.items()}
    assert sum(r["text"] == want[r["page_id"]] for r in got) / len(got) > 0.99
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_extraction_of_other_templates(spark):
    source = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").limit(120).collect()]
    para = ["Long and clear sentences stand here, one after the other. They tell of rivers and of towns, and they go on.", "A second paragraph follows the first one. It is part of the article as well, and it ends here."]
    body = "".join(f"<p>{p}</p>" for p in para)
    odd = [
        (-1, "u", f"<html><body><div class='menu'><ul><li>Home</li><li>News</li></ul></div><div class='content'>{body}</div><div class='comments'><div class='comment'><p>I do not agree with this at all.</p></div></div><div class='footer'>(c) all rights</div></body></html>"),
        (-2, "u", f"<html><body><header>Site name</header><div class='cookie-notice'>We use cookies here.</div><main>{body}</main><aside class='sidebar'><p>Read this too.</p></aside></body></html>"),
        (-3, None, None), (-4, "u", ""), (None, "u", "<p>x"), (-5, "u", "<nav><a>only</a></nav>"),
    ]
    frame = spark.createDataFrame(source + odd, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in H.extract_text(frame).collect()}
    assert got[-1]["text"] == got[-2]["text"] == "\n\n".join(para)
    assert got[-3]["text"] == got[-4]["text"] == got[-5]["text"] == "" and got[-3]["n_chars"] == 0
    assert H.extract_text(frame.limit(0)).count() == 0


def test_few_telling_pages_among_many(spark):
    """Teachers are looked for among all pages, and copies do not take their places."""
    told = "<html><body><nav>Home {0}</nav><article><p>A long sentence number {0} stands here. It goes on.</p></article></body></html>"
    html = [f"<div>page {k}</div>" for k in range(6000)] + [told.format(k) for k in range(6)] + [told.format("copy")] * 300
    model = H.fit(spark.createDataFrame([(x,) for x in html], "html string").repartition(4))
    assert model is not None
    assert H.fit(spark.createDataFrame([(x,) for x in html[:50]], "html string")) is None
    kept = []

    class Seen(H.BlockLabeller):
        def fit(self, pages, **options):
            kept.extend(pages)
            return self

    whole, H.BlockLabeller = H.BlockLabeller, Seen
    try:
        H.fit(spark.createDataFrame([(x,) for x in html], "html string").repartition(4))
        assert len(kept) == 3 * 7  # each page and two variants
        kept.clear()
        H.fit(spark.createDataFrame([(x,) for x in html], "html string").repartition(4), sample=5)
        assert len(kept) == 3 * 5
    finally:
        H.BlockLabeller = whole


def test_labeller_in_stretches():
    rng = np.random.default_rng(0)
    model, page = H.BlockLabeller(), rng.normal(size=(1300, H.WIDTH)).astype(np.float32)
    x, mask = model.padded([page])
    whole = model.output(model.run("f", x, mask), model.run("b", x, mask))[:, 0]
    assert model.long(page)[:512] == pytest.approx(whole[:512], abs=0.05)  # the backward state is carried as well
    assert model.long(page) == pytest.approx(whole, abs=1e-4)


def test_lstm_gradients():
    rng = np.random.default_rng(1)
    model = H.BlockLabeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = rng.normal(size=(5, 3, H.WIDTH)), np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    target = rng.normal(size=(5, 3, H.HIDDEN))

    for way in "fb":
        keep = model.run(way, x, mask)
        grads = model.back(way, x, mask, keep, target * mask[..., None])
        for name in (f"W{way}", f"R{way}", f"b{way}"):
            value = model.p[name]
            at = tuple(rng.integers(0, n) for n in value.shape)
            old = value[at]
            loss = []
            for d in (1e-3, -1e-3):
                value[at] = old + d
                loss.append(float((model.run(way, x, mask)["h"].astype(np.float64) * target * mask[..., None]).sum()))
            value[at] = old
            assert grads[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, abs=2e-2, rel=2e-2)
