"""Term lookup over search documents by an inverted index: no document is read to find out which ones match.

A term of a query matches where it stands within a word of one of the searched fields, in any case. A word has no white
space and nor has a term, so the distinct words (*dictionary*) show which words a term stands in, and only the lists of
those words are read. The lists of a query's terms are intersected by counting.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlink.sources.written import materialise

#: What the search finds persons and mandates by.
PERSON_FIELDS, MANDATE_FIELDS = ("name", "wikipedia_title"), ("party_name", "wahlkreis", "role")
#: Folders of lists.
BUCKETS = 64


def _bucket(word):
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def postings(docs: DataFrame, id_col: str, fields: tuple[str, ...], order_col: str) -> DataFrame:
    """``(word, id, field, rank)``: the distinct words of each searched field of each document, and what results are ordered by.

    In titles underscores part words, as they stand for spaces. Null and empty fields have no words.
    """
    text = lambda c: F.replace(c, F.lit("_"), F.lit(" ")) if c.endswith("title") else F.col(c)
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(text(c)), r"(?U)\s+"), lambda w: w != ""))
    each = F.flatten(F.array(*(F.transform(F.coalesce(words(c), F.array().cast("array<string>")), lambda w, c=c: F.struct(w.alias("word"), F.lit(c).alias("field"))) for c in fields)))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(order_col).alias("rank"), F.explode(each).alias("w"))
    return rows.select("w.word", "id", "w.field", "rank")


@dataclass(frozen=True)
class TermIndex:
    """An index in a folder: lists by word, and the dictionary of words."""

    spark: SparkSession
    path: str
    schema: T.StructType

    @staticmethod
    def write(docs: DataFrame, path: str, id_col: str, fields: tuple[str, ...], order_col: str) -> TermIndex:
        spark = docs.sparkSession
        rows = postings(docs, id_col, fields, order_col).withColumn("bucket", _bucket(F.col("word")))
        # a word of many documents is dealt over several tasks: it is the folder, not the task, that it is found by
        rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{path}/lists")
        index = TermIndex(spark, path, rows.schema)
        index._lists().groupBy("word").agg(F.count("*").alias("documents")).write.parquet(f"{path}/dictionary")
        spark.createDataFrame([(rows.schema.json(),)], "schema string").coalesce(1).write.json(f"{path}/about")
        return index

    @staticmethod
    def open(spark: SparkSession, path: str) -> TermIndex:
        about = spark.read.schema("schema string").json(f"{path}/about").first()
        return TermIndex(spark, path, T.StructType.fromJson(json.loads(about.schema)))

    def _lists(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/lists")

    def matches(self, queries: DataFrame) -> DataFrame:
        """``(query, id, rank)`` of the documents that hold every term of a query (column ``query``); one without terms matches none."""
        terms = queries.select("query", F.array_distinct(F.filter(F.split(F.lower("query"), r"(?U)\s+"), lambda t: t != "")).alias("terms")).distinct()
        each = materialise(terms.select("query", F.size("terms").alias("n"), F.explode("terms").alias("term")))
        dictionary = self.spark.read.parquet(f"{self.path}/dictionary")
        words = materialise(dictionary.join(F.broadcast(each), F.col("word").contains(F.col("term"))).select("query", "n", "term", "word").withColumn("bucket", _bucket(F.col("word"))))
        held = [r[0] for r in words.select("bucket").distinct().collect()]  # as many as folders at most
        lists = self._lists().where(F.col("bucket").isin(held)).select("word", "id", "rank")
        found = lists.join(words.drop("bucket"), "word").select("query", "n", "term", "id", "rank").distinct()
        return found.groupBy("query", "n", "id", "rank").agg(F.count("*").alias("k")).where("k = n").select("query", "id", "rank")

    def first(self, query: str, limit: int = 5) -> DataFrame:
        """Ids of the first ``limit`` documents for one query, by order column and id."""
        return self.matches(self.spark.createDataFrame([(query,)], "query string")).orderBy("rank", "id").limit(limit).select("id")
