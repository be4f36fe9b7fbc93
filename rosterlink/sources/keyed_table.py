"""Stored tables with one row a key, in folders by a hash of the key: an upsert rewrites only the folders it touches."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlink.sources.readers import latest
from rosterlink.sources.written import discard, materialise


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with rows by ``key`` in ``buckets`` folders."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: T.StructType

    @staticmethod
    def write(rows: DataFrame, path: str, key: str, buckets: int = 256) -> KeyedTable:
        """Store ``rows``, which have one row a key (rows without a key are left out)."""
        table = KeyedTable(rows.sparkSession, path, key, buckets, rows.schema)
        table._placed(rows).write.partitionBy("bucket").parquet(f"{path}/rows")
        about = rows.sparkSession.createDataFrame([(key, buckets, rows.schema.json())], "key string, buckets int, schema string")
        about.coalesce(1).write.json(f"{path}/about")
        return table

    @staticmethod
    def open(spark: SparkSession, path: str) -> KeyedTable:
        about = spark.read.schema("key string, buckets int, schema string").json(f"{path}/about").first()
        return KeyedTable(spark, path, about.key, about.buckets, T.StructType.fromJson(json.loads(about.schema)))

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _placed(self, rows: DataFrame) -> DataFrame:
        placed = rows.where(F.col(self.key).isNotNull()).withColumn("bucket", self.bucket(F.col(self.key)))
        return placed.repartition("bucket").sortWithinPartitions("bucket", self.key)

    def _all(self) -> DataFrame:
        # a table without rows has no files to take the columns from
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        return self._all().drop("bucket")

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys (column ``key``): only their folders are read."""
        held = [r[0] for r in keys.select(self.bucket(F.col(self.key))).distinct().collect()]  # as many as folders at most
        mine = self._all().where(F.col("bucket").isin(held)).drop("bucket")
        return mine.join(keys.select(self.key).distinct(), self.key, "left_semi")

    def upsert(self, updates: DataFrame, order: list[str] | None = None) -> int:
        """Replace or add the rows of ``updates``: of several with one key the last by ``order`` (columns that are not stored).

        The folders that keys of ``updates`` fall into are worked out beside the table and then put in the place of the old
        ones; files of all others stay as they are. The same upsert again changes nothing. Returns the number of folders.
        """
        stored = self.rows()
        last = latest(updates.where(F.col(self.key).isNotNull()), [self.key], order) if order else updates.where(F.col(self.key).isNotNull()).dropDuplicates([self.key])
        last = materialise(last.select(*stored.columns).withColumn("bucket", self.bucket(F.col(self.key))))
        touched = [r[0] for r in last.select("bucket").distinct().collect()]  # as many as folders at most
        if touched:
            kept = self._all().where(F.col("bucket").isin(touched)).join(last.select(self.key), self.key, "left_anti")
            merged = materialise(kept.unionByName(last))
            rows = merged.repartition("bucket").sortWithinPartitions("bucket", self.key)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/rows")
            discard(merged)
        discard(last)
        return len(touched)
