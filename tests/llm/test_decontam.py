import re

from candlelake.llm.decontam import contaminated, without_leaks
from llm_tables import make_docs, make_items

ITEM = "A train with Anna leaves at 9 and goes 120 km in 2 hours while Anna reads 3 books how fast is it"


def found(spark, texts, items, **options):
    return {(r["doc_id"], r["item_id"]): r for r in contaminated(make_docs(spark, texts), make_items(spark, items), **options).collect()}


def test_verbatim_reworded_and_clean(spark):
    other = ITEM.replace("Anna", "Peter").replace("120 km", "300 miles").replace("9", "7")
    torn = ITEM.replace("Anna leaves", "Peter leaves")  # Anna becomes Peter in one place only
    texts = [(1, "Some words first. " + ITEM + ". Some words after."), (2, "Before it, " + other), (3, "Before it, " + torn), (4, "nothing of the kind is in this text at all"), (5, ITEM.upper()), (6, None), (7, "")]
    got = found(spark, texts, [(0, ITEM)])
    assert set(got) >= {(1, 0), (2, 0)} and not {(3, 0), (4, 0), (6, 0), (7, 0)} & set(got)
    assert got[1, 0]["same_values"] and not got[2, 0]["same_values"] and got[2, 0]["n_slots"] >= 4


def test_against_plain_containment(spark):
    """Without placeholders the operator is a containment of five-word windows of at least 0.8."""
    import random

    rng = random.Random(2)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(5, 30)))) for k in range(25)]
    texts = []
    for k in range(200):
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        item = rng.choice(items)[1].split()
        cut = item[: rng.randint(len(item) // 2, len(item))]
        if rng.random() < 0.3:
            cut[rng.randrange(len(cut))] = "other"
        at = rng.randint(0, len(own))
        texts.append((k, " ".join(own[:at] + cut + own[at:])))

    def grams(t):
        w = re.sub(r"[^\w\s]", "", t.lower()).split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    want = {(d, i) for d, t in texts for i, q in items if len(grams(t) & grams(q)) / len(grams(q)) >= 0.8}
    got = found(spark, texts, items)
    assert set(got) == want and len(want) > 40
    # several broadcast blocks give the same
    assert set(found(spark, texts, items, block=50)) == want


def test_sql_gives_the_same(spark):
    """The registered SQL on texts with names, numbers and units, reworded, torn and in other case."""
    import duckdb
    from candlelake.llm.queries import DECONTAMINATION

    items = [(0, ITEM), (1, "Is Anna Maria 5 km from Paris, or 6 km from Rome? She asks 7 friends of Anna."), (2, "the plain words of this item have no slots at all here"), (3, "12 34 56 78 90 11 13")]
    swap = [("Anna", "Peter"), ("9", "7"), ("120 km", "300 miles"), ("Paris", "Berlin"), ("6 km", "8 km"), ("3 books", "3.5 books")]
    texts = [(k, t) for k, (_, t) in enumerate(items)]
    texts += [(10 + k, "Before. " + t.replace(a, b) + " after it") for k, (a, b) in enumerate(swap) for _, t in items[:2]]
    texts += [(30, ITEM.lower()), (31, ITEM.title()), (32, ITEM.replace("Anna leaves", "Peter leaves")), (33, None), (34, ""), (35, ITEM + " " + ITEM.replace("Anna", "Olaf"))]
    docs, benchmark = make_docs(spark, texts), make_items(spark, items)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", benchmark.toPandas())
    want = con.execute(DECONTAMINATION).fetchall()
    got = contaminated(docs, benchmark).select("doc_id", "item_id", "coverage", "n_slots", "same_values").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 8


def test_short_items_ties_and_repeats(spark):
    items = [(0, "two words"), (1, "two words"), (2, None), (3, ""), (4, "1 2 3 4 5 6 7 8")]
    texts = [(1, "these two words"), (1, "these two words"), (2, "1 2 3 4 5 6 7 8 9"), (None, "here two words again")]
    got = found(spark, texts, items)
    assert set(got) == {(1, 0), (1, 1), (None, 0), (None, 1)}


def test_stage_and_empty(spark, docs, no_docs):
    items = make_items(spark, [(0, "Same text here")])
    kept = without_leaks(docs, items)
    assert kept.schema == docs.schema
    assert {4, 5} & {r["doc_id"] for r in kept.select("doc_id").collect()} == set()
    assert kept.count() == docs.count() - 3
    assert contaminated(no_docs, items).count() == 0
    assert contaminated(docs, make_items(spark, [])).count() == 0


def test_native(docs, spark):
    plan = contaminated(docs, make_items(spark, [(0, ITEM)]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "Cartesian", "NestedLoop"))


def test_repeated_templates_and_neighbours(spark):
    """Windows met at another place of the item, or in a sentence of the same template, do not discard a copy."""
    item = "A car goes 60 km in 2 hours and then a car goes 80 km in 3 hours before it stops for good near the old bridge at the end of the long road to town"
    sums = "we add 3 plus 4 plus 5 plus 6 plus 7 plus 8 plus 9 and then we write the whole result down on paper"
    other = item.replace("60", "50").replace("80", "90").replace("2 hours", "4 hours").replace("3 hours", "7 hours")
    torn = ITEM.replace("Anna leaves", "Peter leaves")
    texts = [
        (1, "Some words. " + item + ". Some more."), (2, other), (3, item.replace("then a", "then later a")), (4, item + ". A car goes 10 km in 9 hours and then a car goes 11 km in 12 hours."),
        (5, sums), (6, sums.replace("plus 6", "plus about 6")), (7, torn + " and a train goes 5 km in 6 hours"), (8, ITEM + ". He goes 77 km in 8 hours while Olaf reads 5 books how fast is it"),
    ]
    got = found(spark, texts, [(0, item), (1, sums), (2, ITEM)])
    assert {(1, 0), (2, 0), (3, 0), (4, 0), (5, 1), (8, 2)} == set(got) - {(6, 1)}, got
    assert got[1, 0]["same_values"] and got[1, 0]["coverage"] == 1 and got[4, 0]["same_values"] and not got[2, 0]["same_values"]


def test_names_that_start_sentences_and_units_in_other_case(spark):
    names = 'Anna has 5 apples. Anna buys 3 more at the market. "Anna eats 2 of them (Anna likes those) and sells the rest there." Anna then counts what is left'
    units = "the old car goes 120 km in 2 hours and then it stops for 30 minutes near a bridge that is 40 m long"
    peter = names.replace("Anna", "Peter").replace("5", "7")
    texts = [
        (1, names), (2, "Before it. " + peter), (3, "Before it, " + peter), (4, peter.replace("Peter eats", "Olaf eats")), (5, names.lower()),
        (6, units.upper()), (7, units.replace("km", "KM").replace("hours", "Hours").replace("minutes", "Minutes")), (8, units.replace("km", "Miles").replace("hours", "DAYS")), (9, ITEM.upper()),
    ]
    got = found(spark, texts, [(0, names), (1, units), (2, ITEM)])
    assert set(got) == {(1, 0), (2, 0), (3, 0), (5, 0), (6, 1), (7, 1), (8, 1), (9, 2)}, got
    assert got[1, 0]["same_values"] and not got[2, 0]["same_values"]


def test_rows_are_judged_one_by_one(spark):
    """Rows without an id, or with one id, neither add up to a coverage nor go with each other."""
    half = " ".join(ITEM.split()[:12]), " ".join(ITEM.split()[10:])
    rows = [(None, "a clean text without an id"), (None, "Before it, " + ITEM), (5, half[0]), (5, half[1]), (None, half[0]), (None, half[1]), (6, ITEM), (6, "another clean text"), (7, None), (None, None), (8, ITEM), (8, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [tuple(r) for r in without_leaks(docs, make_items(spark, [(0, ITEM)])).collect()]
    assert sorted(kept, key=str) == sorted([r for r in rows if ITEM not in (r[1] or "")], key=str)
    assert contaminated(docs, make_items(spark, [(0, ITEM)])).count() == 3


def nodes(plan):
    below = plan.children()
    return [plan, *[x for k in range(below.size()) for x in nodes(below.apply(k))]]


def joins(frame):
    return [x for x in nodes(frame._jdf.queryExecution().sparkPlan()) if "Join" in x.nodeName()]


def test_hits_do_not_hold_the_whole_text(spark):
    """Hits of one text are held together, so they must not have all its words each."""
    texts, items = make_docs(spark, [(1, ITEM)]), make_items(spark, [(0, ITEM)])
    for options in ({}, {"block": 5}):
        met = joins(contaminated(texts, items, **options))
        names = {x.output().apply(k).name() for x in met for k in range(x.output().size())}
        assert met and not names & {"words", "valued"}


def test_a_repeated_benchmark_takes_one_pass(spark):
    """The documents are read once for all copies of the items, and once for each part of the windows' hashes; the rows stay."""
    other = ITEM.replace("Anna", "Peter").replace("120 km", "300 miles")
    texts = [(k, f"word {k} " * k + (ITEM, other, "nothing of the kind")[k % 3]) for k in range(9)]
    items = [(k, ITEM) for k in range(6)] + [(6, "the plain words of this item have no slots at all here")]
    scans = lambda **o: sum("Scan" in x.nodeName() and "doc_id" in x.toString() for x in nodes(contaminated(make_docs(spark, texts), make_items(spark, items), **o)._jdf.queryExecution().sparkPlan()))
    want = found(spark, texts, items)
    assert {k for k in want if k[1] < 6} == {(d, i) for d in range(9) if d % 3 < 2 for i in range(6)}
    assert scans(block=20) == scans()
    for options in ({"block": 20}, {"block": 20, "hashes": 7}):
        assert found(spark, texts, items, **options) == want
