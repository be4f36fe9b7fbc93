"""Quality by compression: zstandard dictionaries of good and bad text, the size difference calibrated to a score.

A text is cut into blocks of ``BLOCK`` bytes and every block is compressed with either dictionary; so the last block of
a very long text counts as much as its first, and memory is bounded by the text itself. The feature is the compressed
size with the bad dictionary less that with the good one, over the text's bytes; a logistic fit turns it into a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.calibrate import fit_logistic
from rosterlink.llm.common import text_batches, text_chunks

BLOCK = 1024


@dataclass
class QualityModel:
    """Two trained dictionaries (bytes; empty where a class had no text) and the calibration's weights."""

    bad: bytes
    good: bytes
    weights: np.ndarray


def _blocks(data: bytes):
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _training_blocks(batches):
    for batch in batches:
        block, label, order = [], [], []
        for text, y, h in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for k, b in enumerate(_blocks((text or "").encode())):
                block.append(b)
                label.append(y)
                order.append((h + k * 0x9E3779B97F4A7C15) % (1 << 63))
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.binary()), pa.array(label, pa.int32()), pa.array(order, pa.int64())], ["block", "label", "o"])


def _compressor(dictionary: bytes):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if d:
        d.precompute_compress(level=3)
    return zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False).compress


def _differences(bad: bytes, good: bytes):
    """For each text the compressed-size difference over its bytes; 0 for an empty text."""
    by_bad, by_good = _compressor(bad), _compressor(good)

    def of(data: bytes) -> float:
        return sum(len(by_bad(b)) - len(by_good(b)) for b in _blocks(data)) / max(1, len(data))

    return of


def _features(dictionaries):
    def run(batches):
        of = _differences(*dictionaries.value[:2])
        for batch in batches:
            names = batch.schema.names
            x = []
            for _, data, offsets in text_chunks(batch, "text"):
                raw = data.tobytes()
                x += [of(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            keep = [batch.column(i) for i, c in enumerate(names) if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(x, pa.float64())], [*(c for c in names if c != "text"), "x"])

    return run


def fit_quality(sample: DataFrame, max_blocks: int = 4000, dictionary_bytes: int = 65536) -> QualityModel:
    """Train on a bounded ``sample`` (label 0 or 1, text, row), as ``labelled_sample`` draws it.

    The dictionaries are trained on at most ``max_blocks`` blocks of each class in hash order. The calibration is
    cross-fitted: each half of the rows is scored with dictionaries of the other half, so no row is scored by a
    dictionary that holds it. Without rows of both classes the score is the smoothed rate of the label.
    """
    spark = sample.sparkSession
    text_batches(spark)
    rows = sample.select("text", "label", F.col("row").bitwiseAND(F.lit(2**63 - 1)).alias("o")).where("length(text) > 0")

    def blocks(y: int, half: int) -> list[bytes]:
        part = rows.where((F.col("label") == y) & (F.col("o") % 2 == half))
        got = part.mapInArrow(_training_blocks, "block binary, label int, o long").orderBy("o", "block").limit(max_blocks // 2).select("block").collect()
        return [bytes(r[0]) for r in got]

    def dictionary(samples: list[bytes]) -> bytes:
        try:
            return zstandard.train_dictionary(dictionary_bytes, samples, level=3).as_bytes()
        except zstandard.ZstdError:  # too few samples to train on: their bytes serve as a raw dictionary
            return b"".join(samples)[-dictionary_bytes:]

    parts = [[blocks(y, half) for y in (0, 1)] for half in (0, 1)]
    found = []
    for half in (0, 1):
        shared = spark.sparkContext.broadcast([dictionary(p) for p in parts[1 - half]])
        found += rows.where(F.col("o") % 2 == half).select("label", "text").mapInArrow(_features(shared), "label int, x double").collect()
    x, y = np.array([r[1] for r in found]).reshape(-1, 1), np.array([r[0] for r in found], float)
    return QualityModel(*(dictionary(parts[0][y] + parts[1][y]) for y in (0, 1)), fit_logistic(x, y, ridge=1e-6))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows ``(id_col, score, predicted)`` for every row of ``docs``: score 0 to 1, predicted 1 if it is ``threshold`` or more.

    Whole texts are scored; a null or empty text has difference 0 and so the calibration's score of no evidence.
    Repeated rows give repeated results. Null ids stay. Other columns are not read. A very long text is scored block by
    block; a worker holds it twice.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.bad, model.good))
    weights = [float(w) for w in model.weights]
    kind = docs.schema[id_col].dataType.simpleString()
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_features(shared), f"id {kind}, x double")
    score = 1 / (1 + F.exp(-(F.col("x") * weights[0] + weights[1])))
    return x.select(F.col("id").alias(id_col), score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
