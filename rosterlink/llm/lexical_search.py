"""Ranked lexical search: accumulator-limited, term at a time, the rarest first, with an exact result.

1. One pass over the texts counts, for each document, all its terms and, of the terms that some query holds, the
   occurrences. Texts never move and what is written is a row of numbers for each document (*vectors*).
2. Statistics over all documents give each query term its weight and the most it can add to any score.
3. Terms are taken by classes of document frequency, the rarest first. A class's postings meet the queries that are still
   *open* and add to an accumulator for each (query, document). After each class the best accumulators of a query are
   brought up to date with all its terms: the k-th of these scores is a *floor* that the result reaches. When all terms
   that are left can't add as much as that, no new accumulator can matter and the query closes.
4. Accumulators that can still reach the floor are updated exactly with the terms that are left, and ranked.

A document without an accumulator scores less than k others, so the result is the exact one. Common terms, whose postings
are most of the index, are read only for documents that have an accumulator. Queries are answered in blocks of a bounded
number of terms; each block is one pass over all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.llm.common import discard, materialise, text_batches, text_chunks
from rosterlink.llm.shingles import word_spans

#: Terms of the queries that are answered in one pass over the documents (some 60 bytes each on the driver and a worker).
BLOCK_TERMS = 1_000_000
#: Classes of document frequency: each goes to STEP times less than the one before, from all documents down to FEW of them.
STEP, FEW = 4, 64
#: Classes of common terms, more than 1 / STEP ** COMMON of all documents: these have no inverted lists of their own.
COMMON = 2
#: Accumulators brought up to date after a class, as a multiple of the ranks wanted; pairs that a worker scores at once.
WIDE, AT_ONCE = 3, 1 << 14
#: Of the score, all in whole numbers: scales of a weight, a quotient and an occurrence; factor of the length and its parts.
WEIGHT, SCALE, OCCURRENCE, LENGTH, FIXED, VARIABLE = 1000, 1_000_000_000, 1000, 12, 75, 25
#: Bytes that are in no term: ASCII other than letters and digits.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _query_terms(items: DataFrame) -> DataFrame:
    """``(item, term, times)`` of queries (item, text)."""

    def run(batches):
        for batch in batches:
            for row, data, offsets in text_chunks(batch, "text"):
                _, first, start, end = word_spans(data, offsets, breaks=BREAKS)
                text = _LOWER[data].tobytes()
                item = np.repeat(np.asarray(batch.column(0).slice(row, len(offsets) - 1)), np.diff(first))
                terms = pd.DataFrame({"item": item, "term": [text[a:b].decode() for a, b in zip(start.tolist(), end.tolist())]})
                terms = terms.groupby(["item", "term"], as_index=False).size()
                yield pa.RecordBatch.from_arrays([pa.array(terms["item"], pa.int64()), pa.array(terms["term"], pa.string()), pa.array(terms["size"], pa.int32())], ["item", "term", "times"])

    return items.mapInArrow(run, "item long, term string, times int")


class Vocabulary:
    """Distinct terms, numbered as given; found in texts by hash and then compared byte by byte."""

    def __init__(self, terms: list[str]):
        data = [t.encode() for t in terms]
        self.size = len(data)
        self.length = np.array([len(x) for x in data], np.int64)
        self.bytes = np.frombuffer(b"".join(data), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        h = word_spans(self.bytes, self.begin, breaks=BREAKS)[0]
        self.hash, self.number = np.unique(h, return_index=True)
        # terms whose hash another one has are looked for apart
        self.rest = np.setdiff1d(np.arange(self.size), self.number)
        self.more = Vocabulary([terms[k] for k in self.rest]) if len(self.rest) else None

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
        """For each term of a text the number of the equal term here, or -1."""
        if not self.size:
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        found = np.where(self.hash[at] == h, self.number[at], -1)
        left = np.flatnonzero(found >= 0)
        wrong = self.length[found[left]] != (end - start)[left]
        found[left[wrong]] = -1
        left, k = left[~wrong], 0
        while len(left):  # byte k of all terms that have one
            wrong = _LOWER[data[start[left] + k]] != self.bytes[self.begin[found[left]] + k]
            found[left[wrong]] = -1
            left, k = left[~wrong], k + 1
            left = left[self.length[found[left]] > k]
        if self.more:
            other = self.more.find(data, start, end, h)
            found = np.where(other >= 0, self.rest[other], found)
        return found


def _vectors(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``(row, doc_id, n, terms, times)`` of each document with a term: ``n`` counts all its terms, the arrays those of queries."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words = vocabulary.value
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in text_chunks(batch, "text"):
                h, first, start, end = word_spans(data, offsets, breaks=BREAKS)
                found = words.find(data, start, end, h)
                count, base = np.diff(first), words.size + 1
                doc = np.repeat(np.arange(len(count)), count)[found >= 0]
                pair, times = np.unique(doc * base + found[found >= 0], return_counts=True)
                ends = pa.array(np.searchsorted(pair, np.arange(len(count) + 1) * base), pa.int32())
                arrays = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (pair % base, times)]
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(count)), pa.array(count, pa.int64()), *arrays], ["doc_id", "n", "terms", "times"])

    out = docs.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, times array<int>").where("n > 0")
    return materialise(out.withColumn("row", F.monotonically_increasing_id()))


@dataclass
class Plans:
    """The terms of the queries of a block in order of (item, term); query ``k`` has those from ``begin[k]`` to ``begin[k + 1]``."""

    items: np.ndarray
    begin: np.ndarray
    term: np.ndarray
    factor: np.ndarray  # weight by repeats
    terms: int


def _exact(pairs: DataFrame, vectors: DataFrame, plans: Broadcast) -> DataFrame:
    """``(item, row, doc_id, score)`` of pairs (item, row): the whole score, over all terms of the query."""
    kind = vectors.schema["doc_id"].dataType.simpleString()

    def run(batches):
        p = plans.value
        for batch in batches:
            m = np.asarray(batch.column("m"))
            wanted, terms, times = (batch.column(c) for c in ("items", "terms", "times"))
            of_term = np.repeat(np.arange(len(m)), np.diff(np.asarray(terms.offsets)))
            have, tf = of_term * p.terms + np.asarray(terms.flatten()), np.asarray(times.flatten()).astype(np.int64)
            doc, item = np.repeat(np.arange(len(m)), np.diff(np.asarray(wanted.offsets))), np.asarray(wanted.flatten())
            for a in range(0, len(item), AT_ONCE):
                d, i = doc[a : a + AT_ONCE], item[a : a + AT_ONCE]
                place = np.searchsorted(p.items, i)
                size = p.begin[place + 1] - p.begin[place]
                pair = np.repeat(np.arange(len(i)), size)
                entry = np.arange(len(pair)) + np.repeat(p.begin[place] - np.cumsum(size) + size, size)
                key = d[pair] * p.terms + p.term[entry]
                at = np.minimum(np.searchsorted(have, key), len(have) - 1)
                pair, entry, at = (x[have[at] == key] for x in (pair, entry, at))
                score = np.zeros(len(i), np.int64)
                np.add.at(score, pair, p.factor[entry] * (SCALE * tf[at] // (OCCURRENCE * tf[at] + LENGTH * m[d[pair]])))
                rows = pa.array(d)
                yield pa.RecordBatch.from_arrays([pa.array(i), batch.column("row").take(rows), batch.column("doc_id").take(rows), pa.array(score)], ["item", "row", "doc_id", "score"])

    by_row = pairs.groupBy("row").agg(F.collect_list("item").alias("items"))
    return vectors.join(by_row, "row").select("row", "doc_id", "m", "terms", "times", "items").mapInArrow(run, f"item long, row long, doc_id {kind}, score long")


def _first(rows: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows of each item, numbered; a task sends on no more than ``k`` an item."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _plan(terms: pd.DataFrame, stats: pd.DataFrame, n_docs: int) -> pd.DataFrame:
    """The terms of a block (item, number, times) that occur, with factor, class, and what all later classes can add."""
    plan = terms.merge(stats, on="number").sort_values(["item", "number"], ignore_index=True)
    weight = np.floor(WEIGHT * np.log((2.0 * n_docs + 2) / (2.0 * plan["df"] + 1))).astype(np.int64)
    plan["factor"], plan["most"] = plan["times"] * weight, plan["times"] * weight * plan["most"]
    # 0 is the class of the most common terms; the smallest, of up to FEW documents, are one
    rarest = max(0, int(np.floor(np.log(max(1, n_docs / FEW)) / np.log(STEP))))
    plan["class"] = np.minimum(np.floor(np.log(n_docs / plan["df"]) / np.log(STEP) + 1e-9).astype(int), rarest)
    return plan


def _left(plan: pd.DataFrame, k: int) -> pd.Series:
    """By item, the most that the terms of classes more common than ``k`` add."""
    return plan["most"].where(plan["class"] < k, 0).groupby(plan["item"]).sum()


def _block(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame | None:
    """Ranked rows (item, rank, doc_id, score) for a block of queries (item, term, times)."""
    spark = docs.sparkSession
    block = terms.toPandas()  # a bounded number of terms
    words = sorted(set(block["term"]))
    block["number"] = block["term"].map({t: i for i, t in enumerate(words)}).astype(np.int64)
    vectors = _vectors(docs, spark.sparkContext.broadcast(Vocabulary(words)))
    n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    vectors = vectors.withColumn("m", F.expr(f"{FIXED} + ({VARIABLE} * n * {n_docs}L) div {n_terms}L"))
    quotient = f"({SCALE}L * tf) div ({OCCURRENCE}L * tf + {LENGTH} * m)"
    postings = vectors.select("row", "m", F.inline(F.arrays_zip("terms", "times"))).select("row", F.col("terms").alias("number"), F.expr(quotient.replace("tf", "times")).alias("quotient"))
    stats = postings.groupBy("number").agg(F.count("*").alias("df"), F.max("quotient").alias("most")).toPandas()  # one row a term
    plan = _plan(block[["item", "number", "times"]], stats, n_docs)
    if plan.empty:
        return None
    items, begin = np.unique(plan["item"], return_index=True)
    plans = spark.sparkContext.broadcast(Plans(items, np.append(begin, len(plan)), plan["number"].to_numpy(), plan["factor"].to_numpy(), len(words)))

    small = lambda rows, schema: F.broadcast(spark.createDataFrame(list(rows.itertuples(index=False, name=None)), schema))  # noqa: E731  rows of a block
    rare = plan.loc[plan["class"] >= COMMON, ["number", "class"]].drop_duplicates()
    lists = materialise(postings.join(small(rare.astype(int), "number int, class int"), "number"), partition_by="class") if len(rare) else None
    floor, rest = pd.Series(0, items), pd.Series(0, items)
    open_, found = set(items.tolist()), None
    for c in sorted(set(plan["class"]), reverse=True):
        now = plan[(plan["class"] == c) & plan["item"].isin(open_)]
        if len(now):
            met = (lists.where(F.col("class") == int(c)) if c >= COMMON else postings).join(small(now[["number", "item", "factor"]].astype(int), "number int, item long, factor long"), "number")
            added = met.select("item", "row", (F.col("factor") * F.col("quotient")).alias("score"))
            before = found
            found = materialise((added if before is None else added.unionByName(before)).groupBy("item", "row").agg(F.sum("score").alias("score")))
            discard(before)
            best = _exact(_first(found, WIDE * k, F.desc("score"), "row").select("item", "row"), vectors, plans)
            reached = _first(best, k, F.desc("score"), "row").where(F.col("rank") == k).select("item", "score").toPandas()  # one row a query
            floor = np.maximum(floor, reached.set_index("item")["score"].reindex(items, fill_value=0))
        left = _left(plan, c)
        rest[list(open_)] = left[list(open_)]
        open_ -= set(items[(left < floor).to_numpy()].tolist())
        if not open_:
            break
    bounds = pd.DataFrame({"item": items, "least": (floor - rest).to_numpy()}).astype(int)
    alive = found.join(small(bounds, "item long, least long"), "item").where("score >= least").select("item", "row")
    ranked = materialise(_first(_exact(alive, vectors, plans).where("score > 0"), k, F.desc("score"), F.asc_nulls_last("doc_id"), "row").select("item", "rank", "doc_id", "score"))
    discard(vectors, lists, found)
    return ranked


def search(docs: DataFrame, queries: DataFrame, k: int = 20, doc_col: str = "doc_id", query_col: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Rows ``(query_col, rank, doc_col, score)``: the ``k`` documents of highest score above 0 for each query.

    Terms are the longest runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased.
    Equal scores rank by ascending id, rows without an id last; each row of ``docs`` is a document of its own, so repeated
    rows are all ranked, and each row of ``queries`` a query of its own with ranks from 1. Null and empty texts hold no
    term: such documents don't count, such queries have no rows. Very long texts are counted whole: a worker holds one
    such text and about 60 bytes for each of its characters. Other columns of both tables are not read. Empty tables give
    no rows.
    """
    spark = docs.sparkSession
    text_batches(spark)
    docs = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = materialise(queries.select(F.monotonically_increasing_id().alias("item"), F.col(query_col).alias("asked"), F.col(text_col).alias("text")))
    terms = materialise(_query_terms(asked.select("item", "text")))
    blocks = -(-terms.count() // block_terms)
    out = None
    for b in range(blocks):
        ranked = _block(docs, terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k)
        if ranked is not None:
            out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], f"item long, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    return out.join(asked.select("item", "asked"), "item").select(F.col("asked").alias(query_col), "rank", F.col("doc_id").alias(doc_col), "score")
