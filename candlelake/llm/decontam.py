"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders; what is left is its template. Windows
of template words are hash-joined with those of the benchmark items, so a question is found again
when its numbers, names or units were exchanged. A document holds an item if it has at least
``similarity`` of the item's windows at about the same relative places, and if the slots agree:
everywhere the item repeats a value, the document must repeat the value that it puts in its place.
An item can hold one window twice, and other sentences can hold it too, so the slots are judged
alignment by alignment (the distance of a window's places in document and item).
DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import stored

#: Words of a window, share of an item's windows, the most item windows that are broadcast, and the window hashes (8 bytes each) that are broadcast at a time.
WINDOW, SIMILARITY, BLOCK, HASHES = 5, 0.8, 50_000, 1_000_000
#: Words after a number that count as units.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g gram grams kg t ton tons tonnes oz ounces lb lbs pound pounds ml l liter liters litre litres gallon gallons "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kph hz khz mhz ghz w kw mw v volts a amps j joules cal kcal "
    "degree degrees percent dollar dollars cent cents euro euros usd eur gbp kilometer kilometers meter meters metre metres kilogram kilograms"
).split()
#: Marks a placeholder; its type (n, p, u) and the value follow.
MARK = "\u0001"


def canonical(text: Column) -> Column:
    """Canonical words of a text, one space between them; a placeholder is MARK, its type and its value.

    A name (p) is a capitalised word that does not start a sentence, a number (n) a run of digits with its
    separators, a unit (u) one of UNITS after a number. MARK and q stand before a capitalised word that
    starts a sentence or follows a quote or bracket, MARK and v before the mark of a capitalised word
    that is one of UNITS after a number: readings() decides on those. Case and punctuation go.
    """
    units = rf"(?i:{'|'.join(UNITS)})(?!\p{{L}})"
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\x00-\x20\xa0]+", " ")
    # each pattern starts with what it finds, so that most places fail at once
    t = F.regexp_replace(t, r"(?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{N},;:] )", f"{MARK}p")
    t = F.regexp_replace(t, rf"(?=\p{{Lu}}\p{{Ll}})(?<=(?:^| )[^\p{{L}}\p{{N}} {MARK}]{{0,3}})", f"{MARK}q")
    t = F.regexp_replace(t, rf"(?=\p{{N}})(?<![\p{{L}}\p{{N}}{MARK}])", f"{MARK}n")
    t = F.regexp_replace(t, rf"({MARK}n[^ ]* )(?={units})", f"$1{MARK}u")
    t = F.regexp_replace(t, rf"({MARK}n[^ ]* )(?={MARK}[pq]{units})", f"$1{MARK}v")
    t = F.regexp_replace(F.lower(t), rf"[^\p{{L}}\p{{M}}\p{{N}} {MARK}]+", "")
    return F.trim(F.regexp_replace(t, " +", " "))


def readings(rows: DataFrame, text: str, keep: Column) -> DataFrame:
    """(keep, reading, valued, words): a text with its names as placeholders (0), and where that differs with its names as words (1).

    Reading 1 finds a text again whose case was changed. Reading 2 takes every capitalised word for a
    name, those that start sentences too, but units in capitals for units. words: the template, without the values.
    """

    def put(line: Column, *marks: tuple[str, str]) -> Column:
        for mark, by in marks:
            line = F.replace(line, F.lit(mark), F.lit(by))
        return line

    rows = rows.select(keep.alias("k"), canonical(F.col(f"`{text}`")).alias("line"))
    names = put(F.col("line"), (f"{MARK}v", ""), (f"{MARK}q", ""))
    all_names = put(F.col("line"), (f"{MARK}v{MARK}p", f"{MARK}u"), (f"{MARK}v{MARK}q", f"{MARK}u"), (f"{MARK}q", f"{MARK}p"))
    lines = [F.struct(F.lit(k).alias("reading"), line.alias("line")) for k, line in enumerate((names, put(names, (f"{MARK}p", "")), all_names))]
    kept = F.when(F.contains("line", F.lit(f"{MARK}p")), F.array(*lines)).otherwise(F.array(lines[0], lines[2]))
    rows = rows.select("k", F.inline(kept))
    return rows.select("k", "reading", F.split("line", " ").alias("valued"), F.split(F.regexp_replace("line", rf"({MARK}[npu])[^ ]*", "$1"), " ").alias("words"))


def windows(rows: DataFrame, sizes: list[int], keep: list[str]) -> DataFrame:
    """Rows (keep, valued, words) -> one row per window: keep, n_words (of the text), size, at, win, slot (its words, without and with values), h.

    A window has its own words alone: what is joined to the windows of one text is held at once, so the whole text in each
    would take memory in proportion to its length times its hits.
    """
    size = F.explode(F.array(*[F.lit(k) for k in sizes])) if len(sizes) > 1 else F.lit(sizes[0] if sizes else WINDOW)
    rows = rows.withColumn("size", size)
    # no filter on the words: it would be pushed below and make them twice
    starts = F.when(F.size("words") >= F.col("size"), F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    rows = rows.select(*keep, "valued", "words", "size", F.explode(starts).alias("at"))
    win, slot = (F.slice(words, F.col("at"), F.col("size")) for words in ("words", "valued"))
    return rows.select(*keep, F.size("words").alias("n_words"), "size", "at", win.alias("win"), slot.alias("slot")).withColumn("h", F.xxhash64("win"))


def agreeing(hits: Column) -> Column:
    """Sets of hits (off, w, pairs) whose slots agree, as structs of the windows w and the pairs.

    All hits if they agree. Else one set from each alignment (hits of one off) that agrees in itself: it
    takes in the other alignments, nearest first, that agree with what it has. So words put in or
    left out do not cut an occurrence, and windows met at another place of the item do not discard it.
    """

    def one_value(pairs: Column) -> Column:
        return F.size(F.array_distinct(F.transform(pairs, lambda x: x["i_slot"]))) == F.size(pairs)

    def taken(some: Column) -> Column:
        pairs = F.array_distinct(F.flatten(F.transform(some, lambda x: x["pairs"])))
        return F.struct(F.array_distinct(F.transform(some, lambda x: x["w"])).alias("w"), pairs.alias("pairs"))

    def more(have: Column, x: Column) -> Column:
        both = F.struct(F.array_union(have["w"], x["part"]["w"]).alias("w"), F.array_union(have["pairs"], x["part"]["pairs"]).alias("pairs"))
        return F.when(one_value(both["pairs"]), both).otherwise(have)

    def grown(seed: Column, lines: Column) -> Column:
        near = F.array_sort(F.transform(lines, lambda x: F.struct(F.abs(x["off"] - seed["off"]).alias("far"), x["off"].alias("off"), x["part"].alias("part"))))
        return F.aggregate(near, seed["part"], more)

    offs = F.array_distinct(F.transform(hits, lambda x: x["off"]))
    lines = F.transform(offs, lambda o: F.struct(o.alias("off"), taken(F.filter(hits, lambda x: x["off"] == o)).alias("part")))
    lines = F.filter(lines, lambda x: one_value(x["part"]["pairs"]))
    # an array of one array, so that the alignments are made once
    seeds = F.flatten(F.transform(F.array(lines), lambda ls: F.transform(ls, lambda x: grown(x, ls))))
    return F.when(one_value(taken(hits)["pairs"]), F.array(taken(hits))).otherwise(seeds)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, coverage, n_slots, same_values.

    coverage: share of the item's distinct windows that the document has together; n_slots: distinct
    placeholder values of the item met in them; same_values: all of them are unchanged. They are those of
    readings 0 and 1 if these find the item, else of reading 2. Windows with
    fewer than two plain words prove nothing and are left out; items without any other window are never
    found. Items shorter than a window are one window. NULL and empty texts hold nothing; texts of any length
    are read whole. Each row is judged by its own text, also where rows share a doc_id or have none; rows that
    repeat id and text are one document. Of equally good readings of an item none is preferred, the highest
    figures count. Empty tables give no rows; other columns are not read. Options: those of found_items().
    """
    return found_items(docs, benchmark, **options).drop("row")


def found_items(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    window: int = WINDOW, similarity: float = SIMILARITY, block: int = BLOCK, hashes: int = HASHES,
) -> DataFrame:
    """contaminated() with ``row``, a hash of the document's text.

    The documents' windows are held against the distinct hashes of the benchmark's, broadcast ``hashes`` at a time (one pass over the
    documents each). What is left meets the benchmark's windows: broadcast if they are ``block`` at most, else in a shuffle join.
    """
    items = readings(benchmark, item_text, F.col(f"`{item_id}`")).withColumnRenamed("k", "item_id").filter("words[0] <> ''")
    items = items.withColumn("short", F.least(F.size("words"), F.lit(window)))
    sizes = sorted(r[0] for r in items.select("short").distinct().collect())  # 1 to window
    plain = F.size(F.filter("win", lambda w: ~w.startswith(MARK)))
    found = reduce(DataFrame.unionAll, [windows(items.filter(F.col("short") == k).drop("short"), [k], ["item_id", "reading"]) for k in sizes]) if sizes else windows(items.drop("short"), [window], ["item_id", "reading"])
    known = found.select("h", "size", "item_id", "reading", F.col("at").alias("i_at"), "win", F.col("slot").alias("i_slot"), F.col("n_words").alias("i_len"))
    known = stored(known.filter(plain >= F.least(F.lit(2), F.col("size"))), "benchmark-windows")
    total = known.count()
    held = known.groupBy(F.col("item_id").alias("t_id"), F.col("reading").alias("t_reading")).agg(F.count_distinct("win").alias("i_total"))

    own = F.struct(F.col(f"`{doc_id}`").alias("doc_id"), row_hash(text).alias("row"))
    lines = readings(docs, text, own).select("k.doc_id", "k.row", (F.col("reading") == 2).alias("all_names"), "valued", "words")
    each = windows(lines, sizes, ["doc_id", "row", "all_names"]).drop("n_words")
    some = known.select(F.col("h").alias("i_h")).distinct()
    passes = 1 if total <= hashes else max(1, -(-some.count() // hashes))
    met = []
    for k in range(passes):
        part = some if passes == 1 else some.filter(F.pmod("i_h", F.lit(passes)) == k)
        near = each.join(F.broadcast(part), F.col("h") == F.col("i_h"), "left_semi")
        met.append(near if passes == 1 else stored(near, "near-windows"))  # one pass after the other, so that one broadcast is in use
    item = known.withColumnsRenamed({"h": "i_h", "size": "i_size", "win": "i_win"})
    met = (
        reduce(DataFrame.unionAll, met)
        .join(F.broadcast(item) if total <= block else item, (F.col("h") == F.col("i_h")) & (F.col("size") == F.col("i_size")) & (F.col("all_names") == (F.col("reading") == 2)) & (F.col("win") == F.col("i_win")))
        .select("doc_id", "row", "item_id", "reading", "at", "i_at", "i_len", F.xxhash64("i_win").alias("w"), "slot", "i_slot")
    )
    pairs = F.filter(F.arrays_zip("i_slot", "slot"), lambda x: x["i_slot"].startswith(MARK))
    met = met.withColumn("pairs", pairs)
    # occurrences of one item in a document lie an item's length apart: two rows of strips, so that no occurrence is cut by both
    shift = (F.col("at") - F.col("i_at")).cast("double") / (2 * F.col("i_len"))
    strip = F.explode(F.array(F.struct(F.lit(0).alias("r"), F.floor(shift).alias("s")), F.struct(F.lit(1).alias("r"), F.floor(shift + 0.5).alias("s"))))
    enough = F.col("i_total") * similarity
    return (
        met.select("doc_id", "row", "item_id", "reading", F.struct((F.col("at") - F.col("i_at")).alias("off"), "w", "pairs").alias("hit"), strip.alias("strip"))
        .groupBy("doc_id", "row", "item_id", "reading", "strip")
        .agg(F.collect_set("hit").alias("hits"))
        .join(F.broadcast(held) if total <= block else held, (F.col("item_id") == F.col("t_id")) & (F.col("reading") == F.col("t_reading")))
        .filter(F.size(F.array_distinct("hits.w")) >= enough)
        .select("doc_id", "row", "item_id", "reading", "i_total", F.explode(agreeing(F.col("hits"))).alias("part"))
        .select(
            "doc_id", "row", "item_id", "reading", (F.size("part.w") / F.col("i_total")).alias("coverage"), F.size("part.pairs").alias("n_slots"),
            F.forall("part.pairs", lambda x: x["i_slot"] == x["slot"]).alias("same_values"),
        )
        .filter(F.col("coverage") >= similarity)
        .groupBy("doc_id", "row", "item_id")
        .agg(*[F.coalesce(F.max(F.when(F.col("reading") < 2, F.col(c))), F.max(c)).alias(c) for c in ("coverage", "n_slots", "same_values")])
    )


def row_hash(text: str) -> Column:
    return F.xxhash64(F.col(f"`{text}`"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; each is judged by its own text."""
    leaks = found_items(docs, benchmark, doc_id=doc_id, text=text, **options).select(F.col("doc_id").alias("_leak"), F.col("row").alias("_leak_row")).distinct()
    return docs.join(leaks, F.col(f"`{doc_id}`").eqNullSafe(F.col("_leak")) & (row_hash(text) == F.col("_leak_row")), "left_anti")
