"""Helpers shared by the operators: materialised tables, Arrow text access, held-out splits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlink.sources.written import discard, materialise, shared_dir  # noqa: F401

#: Bytes of an Arrow batch of texts; a longer single text is a batch of its own.
BATCH_BYTES = 2 << 20
#: Bytes of text handled at once by the vectorised code; a longer single text is handled alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that texts go to Python in: ``BATCH_BYTES`` each, unless the session has its own bound.

    The default bounds, 10,000 rows and 64 MB, let every task hold several such batches of long texts at once.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "64m").lower() in ("64m", "64mb", "67108864b", "67108864"):
        spark.conf.set(key, str(BATCH_BYTES))


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """True for rows that must not teach: crc32 of the id as text, modulo ``modulus``, is ``remainder``."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", max_rows: int = 12_000) -> DataFrame:
    """Rows ``(label, text, row)`` to fit a classifier on: at most ``max_rows`` labelled ids in hash order, with their texts.

    Ids are drawn from ``labels`` alone (labels other than 0 and 1 are ignored, of contradicting ones the smaller counts),
    so the documents are read once and never shuffled; the ids that are broadcast are ``max_rows`` at most.
    """
    drawn = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    drawn = drawn.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return materialise(texts.join(F.broadcast(drawn), "id").select("label", "text", F.xxhash64("id", "text").alias("row")))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose id is in ``gone``: a broadcast of at most ``broadcast_rows`` ids, else a shuffle.

    A null id counts as an id: if ``gone`` has one, rows without an id go.
    """
    gone = materialise(gone.select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(F.broadcast(gone) if gone.count() <= broadcast_rows else gone, docs[id_col].eqNullSafe(gone["__gone"]), "left_anti")


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Yield ``(first row, bytes, offsets)`` for runs of rows with about ``limit`` bytes of UTF-8 each; null is empty."""
    array = batch.column(batch.schema.get_field_index(column))
    array = array.cast(pa.large_binary()).fill_null(b"")
    n = len(array)
    if not n:
        return
    _, off, data = array.buffers()
    offsets = np.frombuffer(off, np.int64)[array.offset : array.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
