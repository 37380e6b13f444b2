"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

1. *Windows*: runs of ``window`` words of the test items. Equal windows are one, however many items hold them.
2. *Frequencies*: every training token that is a test term is counted.
3. *Rarest terms*: each window picks its ``TERMS`` rarest terms. A window with a term that no document holds can't occur
   and picks none.
4. *Index*: the picked terms' postings ``(term, document, position)`` are read off all documents and stored.
5. *Intersection*: lists are shifted by the terms' offsets in their window, which gives the places where it would have to
   start; a place that all its picked terms name is a candidate. Candidates are compared word by word.

Terms and counts are shuffled as partial sums, places as bits of the terms that name them; the test side is broadcast only
up to ``BROADCAST_ROWS`` and ``BROADCAST_BYTES``, which are counted first, and joined by shuffle beyond.

Words are runs of digits, letters and non-ASCII characters; only A-Z are lower-cased. For candidates all letters are
lower-cased, which merges words but never parts equal ones; the comparison is exact. An item of fewer words than a
window is one window; texts that are null or have no word have none. Items of equal text are all reported; a null
item id is the empty string. Repeated document rows are judged alike; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import base

WINDOW, TERMS = 10, 2
#: Rows, and their bytes as text, of test terms or windows that are sent to every executor at most.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
# What separates words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def exact_words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def folded_words(text: Column) -> Column:
    """As many words as ``exact_words``, equal wherever those are; one form of sigma, as lower-casing picks it by context."""
    return F.array_remove(F.split(F.replace(F.lower(text), F.lit("ς"), F.lit("σ")), SEPARATORS), "")


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it is counted to be small, else as it is."""
    n, size = df.agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def test_items(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(item, item_id, words, folded, size)``: ``size`` is the length of the item's windows."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item_id"), text.alias("text")).distinct()
    return (
        named.select(F.xxhash64("item_id", "text").alias("item"), "item_id", exact_words(F.col("text")).alias("words"), folded_words(F.col("text")).alias("folded"))
        .withColumn("size", F.least(F.size("words"), F.lit(window)))
        .filter("size > 0")
    )


def test_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(win, words, folded)``, every window once, and ``(win, items)``, the items that hold it."""
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    cut = items.select("item_id", "words", "folded", "size", F.explode(starts).alias("s")).select(
        "item_id", F.slice("words", F.col("s"), F.col("size")).alias("words"), F.slice("folded", F.col("s"), F.col("size")).alias("folded")
    )
    # Numbered when they are stored, so that equal numbers mean equal words.
    grouped = cut.groupBy("words").agg(F.first("folded").alias("folded"), F.collect_set("item_id").alias("items"))
    found = base.stored(grouped.withColumn("win", F.monotonically_increasing_id()), "windows")
    return found.select("win", "words", "folded"), found.select("win", "items")


def training_tokens(docs: DataFrame) -> DataFrame:
    return docs.select("key", F.posexplode(folded_words(F.col("text"))).alias("pos", "term"))


def rarest_terms(windows: DataFrame, frequency: DataFrame, terms: int = TERMS) -> DataFrame:
    """``(term, win, offset, bit, asked)``: the rarest terms of every window that can occur, a bit for each."""
    every = windows.select("win", F.posexplode("folded").alias("offset", "term")).join(frequency, "term", "left")
    ranked = every.groupBy("win").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "term"))).alias("r"))
    chosen = ranked.filter(F.col("r")[0]["df"] > 0).select("win", F.slice("r", 1, terms).alias("r"))
    each = chosen.select("win", F.expr("shiftleft(1, size(r)) - 1").alias("asked"), F.posexplode("r").alias("n", "t"))
    return each.select(F.col("t.term").alias("term"), "win", F.col("t.offset").alias("offset"), F.expr("shiftleft(1, n)").alias("bit"), "asked")


def with_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text, key)``; ``key`` is a hash of id and text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))


def counted_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each term occurs in all documents; terms that don't are left out."""
    return base.stored(training_tokens(docs).join(small(terms), "term").groupBy("term").agg(F.count("*").alias("df")), "frequency")


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings ``(term, key, pos)`` of the terms, stored."""
    return base.stored(training_tokens(docs).join(small(terms), "term").select("term", "key", "pos"), "postings")


def occurrences(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``(doc_id, key, n_words, found)`` per row of ``docs``: ``found`` lists every occurrence of a test window as
    ``struct<items, start, size>``; ``key`` is a hash of id and text."""
    base_docs = with_keys(docs, id_col, text_col)
    windows, held_by = test_windows(test_items(benchmark, item_col, item_text_col, window))
    frequency = counted_terms(base_docs, windows.select(F.explode("folded").alias("term")).distinct())
    picked = base.stored(rarest_terms(windows, frequency), "rarest")
    index = positional_index(base_docs, picked.select("term").distinct())
    shifted = index.join(small(picked), "term").select("key", "win", (F.col("pos") - F.col("offset")).alias("start"), "bit", "asked")
    # Rows of equal id and text share a key and name their places together.
    met = shifted.filter("start >= 0").groupBy("key", "win", "start").agg(F.bit_or("bit").alias("bits"), F.first("asked").alias("asked"))
    places = met.filter("bits = asked").join(small(windows.select("win", "words")), "win")
    of_document = places.groupBy("key").agg(F.collect_list(F.struct("win", "start", "words")).alias("places"))
    met_docs = base_docs.join(of_document, "key", "left").withColumn("here", exact_words(F.col("text")))
    same = lambda p: F.slice("here", p["start"] + 1, F.size(p["words"])) == p["words"]
    hits = F.transform(F.filter("places", same), lambda p: F.struct(p["win"].alias("win"), p["start"].alias("start"), F.size(p["words"]).alias("size")))
    judged = base.stored(met_docs.select("doc_id", "key", F.size("here").alias("n_words"), hits.alias("hits")), "judged")
    each = judged.filter(F.size("hits") > 0).select("key", F.inline("hits")).distinct().join(small(held_by), "win")
    found = each.groupBy("key").agg(F.collect_list(F.struct("items", "start", "size")).alias("found"))
    none = F.array().cast("array<struct<items: array<string>, start: int, size: int>>")
    return judged.join(found, "key", "left").select("doc_id", "key", "n_words", F.coalesce("found", none).alias("found"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no test window, with their own columns."""
    found = occurrences(docs, benchmark, id_col, text_col, window=window)
    bad = base.stored(found.filter(F.size("found") > 0).select("key").distinct(), "contaminated")
    key = F.xxhash64(docs[f"`{id_col}`"], F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")))
    return docs.join(bad, key == bad["key"], "left_anti")


def hit_words(found: Column) -> Column:
    """How many words lie in any occurrence."""
    return F.size(F.array_distinct(F.flatten(F.transform(found, lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1)))))


def item_list(found: Column) -> Column:
    """The items that occur, sorted as strings."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda h: h["items"]))))


def proximity(
    docs: DataFrame, benchmark: DataFrame, within: int, terms: int = 3, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, start)``: positions from which ``within`` words hold the item's ``terms`` rarest terms, in
    any order. Items with fewer distinct terms use all they have; an item with a term that no document holds has none."""
    base_docs = with_keys(docs, id_col, text_col).distinct()
    items = base.stored(test_items(benchmark, item_col, item_text_col, WINDOW), "items")
    pairs = items.select("item", "item_id", F.explode("folded").alias("term")).distinct()
    ranked = pairs.join(counted_terms(base_docs, pairs.select("term").distinct()), "term", "left").withColumn(
        "r", F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("df", F.lit(0)), "term"))
    ).filter(F.col("r") <= terms)
    asked = base.stored(
        ranked.withColumn("asked", F.count("*").over(Window.partitionBy("item"))).select("item", "item_id", "term", "asked"), "asked"
    )
    postings = positional_index(base_docs, asked.select("term").distinct()).join(small(asked), "term")
    ahead = Window.partitionBy("key", "item").orderBy("pos").rangeBetween(0, within - 1)
    near = postings.withColumn("n", F.size(F.collect_set("term").over(ahead))).filter("n = asked")
    return near.join(base_docs.select("key", "doc_id"), "key").select("doc_id", "item_id", F.col("pos").cast("long").alias("start"))
