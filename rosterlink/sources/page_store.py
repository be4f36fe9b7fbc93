"""Stored pages by key: narrow keys first, then only the pages that are wanted, whose HTML is never shuffled.

A page's key columns are a few bytes and its HTML many thousands, so jobs choose pages on keys alone (columnar files give
those without the HTML) and ``whole_pages`` fetches what was chosen. Wanted keys are broadcast, ``BLOCK`` at a time: pages
stay where they are read, whatever their number. A *page store* keeps pages in folders by a hash of their title; there,
only the folders that hold wanted titles are read at all.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlink.functions.text import underscored
from rosterlink.sources.written import materialise

#: Keys that are broadcast at once (some hundred bytes each).
BLOCK = 500_000
#: Columns that order the stored copies of a page, as far as the table has them: the last fetched one first of all.
ORDER = ("retrieved_at", "revision_id", "sha256")


def bucket_of(title: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(underscored(title)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class PageStore:
    """Pages in ``buckets`` folders by the hash of their title."""

    spark: SparkSession
    path: str
    buckets: int
    schema: T.StructType

    @staticmethod
    def write(pages: DataFrame, path: str, buckets: int = 256) -> PageStore:
        """Store pages (``page_title`` and any other columns); this is the one time that HTML is shuffled."""
        spark = pages.sparkSession
        placed = pages.withColumn("bucket", bucket_of(F.col("page_title"), buckets))
        placed.repartition("bucket").sortWithinPartitions("bucket", "page_title").write.partitionBy("bucket").parquet(f"{path}/pages")
        spark.createDataFrame([(buckets, placed.schema.json())], "buckets int, schema string").coalesce(1).write.json(f"{path}/about")
        return PageStore(spark, path, buckets, placed.schema)

    @staticmethod
    def open(spark: SparkSession, path: str) -> PageStore:
        about = spark.read.schema("buckets int, schema string").json(f"{path}/about").first()
        return PageStore(spark, path, about.buckets, T.StructType.fromJson(json.loads(about.schema)))

    def pages(self, titles: DataFrame | None = None) -> DataFrame:
        """All pages, or those in the folders of some titles (column ``page_title``); a page's columns and ``bucket``."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/pages")
        if titles is None:
            return rows
        held = [r[0] for r in titles.select(bucket_of(F.col("page_title"), self.buckets)).distinct().collect()]  # as many as folders at most
        return rows.where(F.col("bucket").isin(held))


def pages_of(pages: DataFrame | PageStore, titles: DataFrame | None = None) -> DataFrame:
    """The table of pages to look for ``titles`` in."""
    return pages.pages(titles) if isinstance(pages, PageStore) else pages


def latest_keys(pages: DataFrame | PageStore, titles: DataFrame | None = None) -> DataFrame:
    """``(page_title, order, copies)`` of the last fetched response of each title, or each of ``titles``, found on keys alone
    and written.

    The order is by time, then revision, then hash, as far as the table has them; ``copies`` counts the responses that are
    equal in all of these.
    """
    table = pages_of(pages, titles)
    rows = table.select(underscored(F.col("page_title")).alias("page_title"), F.struct(*[c for c in ORDER if c in table.columns]).alias("order"))
    if titles is not None:
        rows = rows.join(titles.select(underscored(F.col("page_title")).alias("page_title")).distinct(), "page_title", "left_semi")
    counted = rows.groupBy("page_title", "order").agg(F.count("*").alias("copies"))
    best = counted.groupBy("page_title").agg(F.max(F.struct("order", "copies")).alias("m"))
    return materialise(best.select("page_title", "m.order", "m.copies"))


def whole_pages(pages: DataFrame | PageStore, wanted: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """``columns`` of the pages that ``wanted`` (page_title, order, copies, as of ``latest_keys``) names, and its other columns.

    Wanted keys are broadcast in blocks, each with the pages of its own folders where pages are in a store. Of equal copies
    the one with the smallest values stays; only such copies are ever shuffled.
    """
    wanted = materialise(wanted)
    n = wanted.count()
    blocks = max(1, -(-n // block))
    kept = [c for c in wanted.columns if c not in ("page_title", "order", "copies")]
    cut = F.pmod(F.floor(bucket_of(F.col("page_title"), pages.buckets) * blocks / pages.buckets), F.lit(blocks)) if isinstance(pages, PageStore) else F.pmod(F.xxhash64("page_title"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        keys = wanted.where(cut == b) if blocks > 1 else wanted
        table = pages_of(pages, keys)
        keys = keys.select(F.col("page_title").alias("__title"), F.col("order").alias("__order"), F.col("copies").alias("__copies"), *(F.col(c).alias(f"__{c}") for c in kept))
        order = F.struct(*[c for c in ORDER if c in table.columns])
        met = table.join(F.broadcast(keys), (underscored(F.col("page_title")) == F.col("__title")) & order.eqNullSafe(F.col("__order")))
        parts.append(met.select("__title", *(f"__{c}" for c in kept), "__copies", *columns))
    found = reduce(DataFrame.unionByName, parts)
    rest = [c for c in columns if c != "page_title"]
    names = [F.col("__title").alias("page_title"), *(F.col(f"__{c}").alias(c) for c in kept)]
    if wanted.where("copies > 1").isEmpty():
        return found.select(*names, *rest)
    twice = found.where("__copies > 1").groupBy("__title", *(f"__{c}" for c in kept)).agg(F.min_by(F.struct(*rest), F.struct(*[c for c in rest if not _unordered(found, c)])).alias("m"))
    return found.where("__copies = 1").select(*names, *rest).unionByName(twice.select(*names, "m.*"))


def latest_of(pages: DataFrame | PageStore, titles: DataFrame, columns: list[str]) -> DataFrame:
    """``page_title`` and ``columns`` of the last fetched response of each of ``titles``."""
    return whole_pages(pages, latest_keys(pages, titles), columns)


def _unordered(table: DataFrame, column: str) -> bool:
    """Whether values of the column have no order."""
    return "map<" in table.schema[column].dataType.simpleString()
