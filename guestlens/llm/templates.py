"""Benchmark decontamination by templates: numbers, units and names become placeholders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm.common import BROADCAST_ROWS, join_small, landed, materialize, text_key

# A leak is a run of so many tokens with the template of an item, in which at
# least so many are plain words. Every such run holds one whole aligned block.
# Of an item with fewer tokens the run is the whole item, with as great a share
# of plain words.
RUN, PLAIN = 13, 8
BLOCK = RUN // 2 + 1
# Per set of a block's places that hold names, as bits: the sets of places that
# may have other names in a leak.
_SUBSETS = [[s for s in range(1 << BLOCK) if not s & ~names and s.bit_count() <= RUN - PLAIN] for names in range(1 << BLOCK)]
NUMBER, UNIT, NAME = "\x01", "\x02", "\x03"
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec min h hr hrs day days week weeks month months year years "
    "percent usd eur gbp dollar dollars cent cents euro euros pound pounds inch inches foot feet yard yards mile miles "
    "meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters "
    "litre litres second seconds minute minutes hour hours"
).split()
_NUMBER = r"[0-9]+(?:[.,:/][0-9]+)*"
_TOKEN = _NUMBER + r"|\p{L}+"
# Capitals that begin names: Latin, Greek and Cyrillic.
_CAPITAL = "A-ZÀ-ÖØ-ÞΑ-ΫА-Я"
# One character stands for each kind of slot; texts do not have them.
_MARKS = "\x01\x02\x03"


def _clean(text: Column) -> Column:
    """The text without the marks, and without a capital that lower-cases to two characters."""
    return F.translate(F.coalesce(text, F.lit("")), _MARKS + "İ", "   I")


def _marked(text: Column) -> Column:
    """Numbers, and units behind numbers, replaced by their marks."""
    units = rf"(?i){_NUMBER}[^\p{{L}}0-9]*(?:{'|'.join(UNITS)})(?!\p{{L}})"
    marked = F.regexp_replace(F.regexp_replace(text, units, " \x01 \x02 "), _NUMBER, " \x01 ")
    return F.when(F.regexp_like(text, F.lit("[0-9]")), marked).otherwise(text)


def _tokens(marked: Column) -> Column:
    """The lower-case words and marks of a text."""
    rest = rf"[^\p{{L}}{_MARKS}]+"
    return F.split(F.regexp_replace(F.lower(marked), "^" + rest, ""), rest)


def _named(marked: Column) -> Column:
    """Names replaced by their mark."""
    return F.regexp_replace(marked, rf"(?<!\p{{L}})[{_CAPITAL}]\p{{L}}*", "\x03")


def _with_templates(df: DataFrame) -> DataFrame:
    """Adds _plain (tokens, numbers and units marked) and _named (names marked too)."""
    df = df.withColumn("_marked", _marked(_clean(F.col("text"))))
    return df.withColumn("_plain", _tokens(F.col("_marked"))).withColumn("_named", _tokens(_named(F.col("_marked")))).drop("_marked")


def _with_tokens(df: DataFrame) -> DataFrame:
    """Adds the templates and _raw, the tokens themselves in lower case, place by place."""
    raw = F.regexp_extract_all(F.lower(_clean(F.col("text"))), F.lit(_TOKEN), 0)
    return _with_templates(df).withColumn("_raw", raw)


def _opened(df: DataFrame, key: str, at: str, step: int, size: int = BLOCK) -> DataFrame:
    """(key, at, h): hashes of the blocks of ``size`` tokens that begin at every ``step``-th token.

    A block has one hash per choice of its names that are marked; all others are
    plain words. Two blocks whose tokens are equal or both names, at each place,
    share the hash that marks the names that differ.
    """
    last = F.size("_plain") - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    bits = range(size)
    subsets = F.array(*[F.array(*[F.lit(s) for s in own]) for own in _SUBSETS[: 1 << size]])

    def names(i: Column) -> Column:
        return sum((F.when(F.get("_named", i + j) == NAME, 1 << j).otherwise(0) for j in bits), F.lit(0))

    def block(i: Column, marked: Column) -> Column:
        tokens = [F.when(marked.bitwiseAND(F.lit(1 << j)) != 0, NAME).otherwise(F.get("_plain", i + j)) for j in bits]
        return F.xxhash64(*tokens)

    opened = df.select(key, "_plain", F.explode(F.transform(starts, lambda i: F.struct(i.alias("at"), names(i).alias("names")))).alias("_b"))
    plain = F.slice("_plain", F.col("_b.at") + 1, size)
    opened = opened.select(key, F.col("_b.at").alias(at), plain.alias("_plain"), F.explode(F.get(subsets, F.col("_b.names"))).alias("_s"))
    return opened.select(key, at, block(F.lit(0), F.col("_s")).alias("h"))


def _leaks(same: str, doc: str, item: str, slot: str, name: str, run: str) -> Column:
    """The places in aligned arrays where a leak of ``run`` tokens begins.

    All tokens fit the template, enough of them are words that are the same, and
    slots and names are consistent: equal values in the item have equal values in
    the document, different ones different values.
    """

    def holds(i: Column) -> Column:
        places = F.sequence(i, i + F.col(run) - 1)
        loose = F.size(F.filter(places, lambda k: F.get(slot, k)))
        slots = F.filter(places, lambda k: F.get(slot, k) | F.get(name, k))
        mine = F.transform(slots, lambda k: F.get(doc, k))
        theirs = F.transform(slots, lambda k: F.get(item, k))
        pairs = F.size(F.array_distinct(F.arrays_zip(mine, theirs)))
        return (
            F.forall(places, lambda k: F.get(same, k))
            & (RUN * loose <= (RUN - PLAIN) * F.col(run))
            & (pairs == F.size(F.array_distinct(mine)))
            & (pairs == F.size(F.array_distinct(theirs)))
        )

    last = F.size(same) - F.col(run)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), holds)).otherwise(F.array().cast("array<int>"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_row, item_id, n_runs): documents that repeat an item.

    ``docs`` has text and _row, which names the text; copies of a text may share it.

    Every block of an item's template, at all places, is hash-joined with the
    blocks of a document's template that follow one another. A leak of ``RUN``
    tokens holds one of those whole, under the rule by which the tokens are
    checked, so none is missed. Blocks follow more closely, or are shorter, where
    an item has fewer tokens. Pairs that meet are aligned and checked token by token.
    """
    items = _with_tokens(benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct())
    items = items.withColumn("_item", F.xxhash64("item_id", "text")).where(F.size("_raw") > 0)
    items = materialize(items.select("_item", "item_id", "_raw", "_plain", "_named"), "items")
    tokens = _with_templates(docs.select("_row", "text")).select("_row", "_plain", "_named")
    # Per size of blocks (of at most BLOCK tokens) the smallest run that has to hold one.
    run = F.least(F.size("_raw"), F.lit(RUN))
    sizes = items.groupBy(F.least(run, F.lit(BLOCK)).alias("size")).agg(F.min(run).alias("run")).collect()
    own, blocks = [], []
    for size, least in sizes:
        own.append(_opened(items.where(F.least(run, F.lit(BLOCK)) == size), "_item", "_off", 1, size))
        blocks.append(_opened(tokens, "_row", "_at", least - size + 1, size))
    own = own or [_opened(items, "_item", "_off", 1)]
    blocks = blocks or [_opened(tokens.limit(0), "_row", "_at", BLOCK)]
    wanted = materialize(reduce(DataFrame.union, own).distinct(), "item-blocks")
    blocks = reduce(DataFrame.union, blocks)
    # Items are a stated query set, but their number is checked all the same; a row is three numbers.
    small = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    met = blocks.join(small, "h").select("_row", "_item", (F.col("_at") - F.col("_off")).alias("_shift")).distinct()
    met = materialize(met, "met")
    rows = materialize(met.select("_row").distinct(), "met-rows")
    own = join_small(docs.select("_row", "text"), rows, ["_row"], "left_semi")
    # Copies of a text are looked at once.
    own = own.dropDuplicates(["_row"])
    own = materialize(_with_tokens(own).drop("text"), "met-templates")
    other = items.select("_item", "item_id", *[F.col(c).alias(f"{c}2") for c in ("_raw", "_plain", "_named")])
    pairs = met.join(own, "_row")
    pairs = join_small(pairs, other, ["_item"], "inner", F.xxhash64("_row"))

    start = F.greatest(F.col("_shift"), F.lit(0))
    length = F.least(F.size("_raw"), F.col("_shift") + F.size("_raw2")) - start
    mine = {c: F.slice(c, start + 1, F.greatest(length, F.lit(0))) for c in ("_raw", "_plain", "_named")}
    theirs = {c: F.slice(f"{c}2", start - F.col("_shift") + 1, F.greatest(length, F.lit(0))) for c in mine}
    aligned = pairs.select(
        "_row",
        "item_id",
        F.zip_with(
            F.zip_with(mine["_plain"], theirs["_plain"], lambda a, b: a == b),
            F.zip_with(mine["_named"], theirs["_named"], lambda a, b: a == b),
            lambda a, b: a | b,
        ).alias("_same"),
        mine["_raw"].alias("_doc"),
        theirs["_raw"].alias("_own"),
        F.zip_with(
            F.zip_with(mine["_plain"], theirs["_plain"], lambda a, b: a != b),
            mine["_plain"],
            lambda differs, a: differs | a.isin(NUMBER, UNIT),
        ).alias("_slot"),
        F.transform(theirs["_named"], lambda a: a == NAME).alias("_name"),
        F.least(F.size("_raw2"), F.lit(RUN)).alias("_run"),
    )
    # Written, so that the arrays are not built anew at each place that is looked at.
    aligned = materialize(aligned, "aligned")
    runs = aligned.select("_row", "item_id", F.size(_leaks("_same", "_doc", "_own", "_slot", "_name", "_run")).alias("n"))
    return runs.where("n > 0").groupBy("_row", "item_id").agg(F.sum("n").alias("n_runs"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document, and contaminated, item_ids (ascending), n_runs.

    Copies of benchmark passages are found whatever their case, punctuation and
    white space, and with other numbers, units or names in their places. An item
    of fewer than 13 tokens is matched as a whole. Null and empty texts and items
    match nothing. Items without an id are left out; equal items count once.
    Equal texts are judged alike, and once: a text is named by two hashes of it,
    the same in every scan. ``keep`` may name any columns. Empty tables give no leaks.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_keep"), "text", text_key("text").alias("_row"))

    def make() -> DataFrame:
        leaks = find_leaks(rows.select("_row", "text").where("text IS NOT NULL"), benchmark)
        return leaks.groupBy("_row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.sum("n_runs").alias("n_runs"))

    joined = join_small(rows, landed(docs.sparkSession, "leaks", make), ["_row"], "left", F.xxhash64("_keep"))
    return joined.select(
        *[F.col("_keep").getField(c).alias(c) for c in keep],
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"),
    )
