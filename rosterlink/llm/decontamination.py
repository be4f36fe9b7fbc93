"""Benchmark decontamination by spaced-seed hashing.

Test items and training texts are cut into words (runs of letters and digits, lower-cased). A mask is laid at every
position and hashes only the words under its ones, so a substituted word under a zero does not matter, and of several
different masks one still hits between substitutions. Training hashes are joined with the test hashes: by a broadcast of
these while they are few, else in one shuffled join of those whose bit is set in a bitmap of all test hashes. Around each hit a window of the item is laid along the text and the
words that agree there, one step of slack for an inserted or missing word, are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.common import materialise

#: The masks, ones are the words that count.
MASKS = ("1110111", "110100111", "1100101011")
#: Test hashes (28 bytes each), windows of items (30 bytes and 8 for each word) and hit ids that are broadcast; more of
#: them meet the documents in a shuffle.
BROADCAST_SEEDS, BROADCAST_WINDOWS, BROADCAST_IDS = 1_000_000, 50_000, 1_000_000
#: Words of one block of a text; 64-bit words of the bitmap of test hashes (8 MB).
BLOCK, WORDS = 256, 1 << 20


def word_hashes(text: Column) -> Column:
    """Array of hashes of a text's words; null and wordless texts have none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _keys(h: Column, i: Column) -> Column:
    """One hash a mask for position i (from 0), null where the mask would reach past the end."""
    return F.array(*(
        F.when(i + len(mask) <= F.size(h), F.xxhash64(F.lit(k), *(F.get(h, i + at) for at, c in enumerate(mask) if c == "1")))
        for k, mask in enumerate(MASKS)
    ))


def _blocks(df: DataFrame, more: int, *keep: str) -> DataFrame:
    """The kept columns, block number ``k`` and ``w``: the words of array ``h`` from ``k * BLOCK`` on, ``BLOCK + more`` at most.

    No row carries a whole long text along.
    """
    # explode_outer, so that the optimiser does not work the arrays out a second time for a filter
    numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size("h") - 1, F.lit(0)) / BLOCK).cast("int"))
    cut = F.transform(numbers, lambda k: F.struct(k.alias("k"), F.slice("h", k * BLOCK + 1, BLOCK + more).alias("w")))
    return df.select(*keep, F.explode_outer(cut).alias("b")).select(*keep, "b.k", "b.w")


def _seeds(df: DataFrame, *keep: str) -> DataFrame:
    """A row for each position and mask of array ``h``: the kept columns, position ``i`` and ``key``."""
    cut = _blocks(df, max(map(len, MASKS)) - 1, *keep)
    each = cut.select(*keep, "k", "w", F.explode_outer(F.sequence(F.lit(0), F.lit(BLOCK - 1))).alias("j"))
    return each.select(*keep, (F.col("k") * BLOCK + F.col("j")).alias("i"), F.explode_outer(_keys(F.col("w"), F.col("j"))).alias("key"))


def _bitmap(seeds: DataFrame) -> DataFrame:
    """One row with ``bits``: for every seed the bit is set that its key points at; WORDS * 8 bytes, whatever their number."""
    word, bit = F.pmod(F.shiftright("key", 6), F.lit(WORDS)), F.expr("shiftleft(1L, cast(key & 63 as int))")
    some = seeds.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("b"))
    every = seeds.sparkSession.range(WORDS).withColumnRenamed("id", "word").join(some, "word", "left").select("word", F.coalesce("b", F.lit(0)).alias("b"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "b"))), lambda x: x["b"]).alias("bits")).withColumn("one", F.lit(1))


def _met(of_docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds of documents joined with those of items. Where these are too many to broadcast, a bitmap of their keys goes to the
    documents first, so that only what may meet one is shuffled."""
    if seeds.count() <= BROADCAST_SEEDS:
        return of_docs.join(F.broadcast(seeds), "key")
    bits = F.broadcast(materialise(_bitmap(seeds)))  # one row of bounded size
    is_set = F.expr(f"shiftrightunsigned(get(bits, cast(pmod(shiftright(key, 6), {WORDS}) as int)), cast(key & 63 as int)) & 1L = 1L")
    passing = of_docs.where("key is not null").withColumn("one", F.lit(1)).join(bits, "one").where(is_set).select(*of_docs.columns)
    return passing.join(seeds, "key")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = 0.7, window: int = 25) -> DataFrame:
    """Rows ``(id_col, item_col, matched, n_window, n_words)`` of documents that hold a test item or a passage of one.

    A document holds an item if, around some hit, ``share`` of a window of ``window`` of the item's words (of all, if it
    has fewer) agree in place with the document's. ``matched`` is the most that agree in one window of ``n_window``
    words; ``n_words`` is the item's length. Items shorter than the shortest mask are too short to be evidence and are
    never reported; null and empty texts hold nothing. Rows of one id count as one document, and so do rows of one item.
    Null ids are kept and count as one document; items without an id are left out. Other columns are not read. A very
    long text is cut into blocks of ``BLOCK`` words, so that no row carries it along. Empty tables give no rows.
    """
    items = benchmark.select(F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("h"))
    items = materialise(items.where(F.col("item").isNotNull() & (F.size("h") >= min(map(len, MASKS)))).distinct())
    # a hit's window has the hit about in its middle, and lies within the item
    last = F.greatest(F.col("size") - window, F.lit(0))
    begin = F.least(F.greatest(F.col("i") + 4 - window // 2, F.lit(0)), last)
    seeds = _seeds(items.withColumn("size", F.size("h")), "item", "size").where("key is not null")
    seeds = materialise(seeds.select("item", "key", begin.alias("begin"), (F.col("i") - begin).alias("lead")))
    starts = F.sequence(F.lit(0), F.greatest(F.size("h") - window, F.lit(0)))
    windows = items.select("item", F.size("h").alias("n_words"), F.explode_outer(F.transform(starts, lambda s: F.struct(s.alias("begin"), F.slice("h", s + 1, window).alias("said")))).alias("x"))
    windows = materialise(windows.select("item", "n_words", "x.*").distinct())

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hits = _met(_seeds(rows.select("id", word_hashes(F.col("text")).alias("h")), "id"), seeds)
    hits = materialise(hits.select("id", "item", "begin", (F.col("i") - F.col("lead")).alias("at")).distinct())
    ids = materialise(hits.select("id").distinct())
    held = rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, rows["id"].eqNullSafe(ids["id"]), "left_semi")
    blocks = _blocks(held.select("id", word_hashes(F.col("text")).alias("h")), window + 2, "id")
    hits = hits.select(F.col("id").alias("hit_id"), "item", "begin", "at", F.floor(F.greatest(F.col("at") - 1, F.lit(0)) / BLOCK).cast("int").alias("hit_k"))
    laid = hits.join(blocks, F.col("hit_id").eqNullSafe(F.col("id")) & (F.col("hit_k") == F.col("k")))
    laid = laid.join(F.broadcast(windows) if windows.count() <= BROADCAST_WINDOWS else windows, ["item", "begin"])

    def same(word: Column, j: Column) -> Column:
        p = F.col("at") + j - F.col("k") * BLOCK
        return F.exists(F.array(p - 1, p, p + 1), lambda q: (q >= 0) & (F.get("w", F.when(q >= 0, q).otherwise(0)) == word))

    matched = F.size(F.filter("said", lambda word, j: F.coalesce(same(word, j), F.lit(False))))
    got = laid.select("id", "item", "n_words", F.size("said").alias("n_window"), matched.alias("matched"))
    best = got.where(F.col("matched") >= F.col("n_window") * share).groupBy("id", "item").agg(F.max(F.struct("matched", "n_window", "n_words")).alias("m"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "m.matched", "m.n_window", "m.n_words")
