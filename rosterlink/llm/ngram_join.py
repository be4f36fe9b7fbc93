"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

Every text is lower-cased (A-Z) and cut into words; its set is the distinct hashes of its word n-grams. Two texts link
when ``100 * |intersection| >= threshold * |union|``. The steps:

1. One pass hashes every text: the hash of its whole word sequence (texts with equal sequences are one *node*), the
   size of its set, a small histogram of the set for the suffix filter, and a count sketch of all n-grams.
2. The sketch (a fixed number of counters, summed by Spark over all texts, one byte each) orders n-grams rare first.
   Any fixed order gives the same links; a rarer prefix only gives fewer candidates.
3. A second pass emits each text's prefix: its rarest ``n - ceil(t n) + 1`` n-grams with their positions. N-grams of one
   node alone are dropped.
4. Candidates that pass the length, positional and suffix filters are verified once with their whole sets.

Large groups of near copies do not give all their pairs: ``star_links`` looks for links by rounds of leaders and then
by one round over all pairs that are left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.common import discard, materialise, text_batches, text_chunks
from rosterlink.llm.shingles import ngram_sets, word_hashes
from rosterlink.llm.star_links import WholeSets, component_rows, node_of, signature, star_links

#: Counters of the n-gram sketch and of one stored slice of it; bins of the suffix histogram.
SKETCH, SLICE, BINS = 1 << 21, 1 << 14, 64
#: N-grams that a task gathers before it counts them: 8 bytes each, a few times over.
FLUSH = 1 << 18


def _profile(size: int, seed: int):
    """Step 1: a row for each text, then slices of this task's sketch (32 bits a counter: a task counts fewer n-grams)."""

    def run(batches):
        sketch, waiting, held = np.zeros(SKETCH, np.uint32), [], 0

        def count():
            slot, times = np.unique(np.concatenate(waiting) & np.uint64(SKETCH - 1), return_counts=True)
            sketch[slot] += times.astype(np.uint32)

        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in text_chunks(batch, "text"):
                words, first = word_hashes(data, offsets, seed)
                node, check, sizes, bins, sigs = [], [], [], [], []
                for i, s in enumerate(ngram_sets(words, first, size)):
                    a, b = node_of(words[first[i] : first[i + 1]])
                    node.append(a if len(s) else None)
                    check.append(b if len(s) else None)
                    sizes.append(len(s))
                    bins.append(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=BINS).tolist() if len(s) else None)
                    sigs.append(signature(s) if len(s) else None)
                    waiting.append(s)
                    held += len(s)
                if held > FLUSH:
                    count()
                    waiting.clear()
                    held = 0
                k = len(node)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, k), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(sizes, pa.int32()),
                     pa.array(bins, pa.list_(pa.int32())), pa.array(sigs, pa.list_(pa.int64())), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                    ["doc_id", "node", "chk", "n", "bins", "sig", "slot", "counts"])
        if waiting:
            count()
        if sketch.any():
            pack = zstandard.ZstdCompressor(level=1).compress
            slots = [k for k in range(SKETCH // SLICE) if sketch[k * SLICE : (k + 1) * SLICE].any()]
            counts = [pack(sketch[k * SLICE : (k + 1) * SLICE].astype(np.int64).tobytes()) for k in slots]
            k = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, ids.type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, pa.list_(pa.int64())),
                 pa.array(slots, pa.int32()), pa.array(counts, pa.binary())],
                ["doc_id", "node", "chk", "n", "bins", "sig", "slot", "counts"])

    return run


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    unpack = zstandard.ZstdDecompressor().decompress
    total = sum(np.frombuffer(unpack(c, max_output_size=SLICE * 8), np.int64) for c in pdf["counts"])
    return pd.DataFrame({"slot": pdf["slot"].iloc[:1], "lane": [0], "counts": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})


def _levels(sketch: DataFrame) -> np.ndarray:
    """The summed sketch as one byte a counter: eight steps for each doubling of the count. SKETCH bytes, whatever the input."""
    schema = "slot int, lane int, counts binary"
    lanes = sketch.groupBy("slot", "lane").applyInPandas(_add, schema).groupBy("slot").applyInPandas(_add, schema)
    out, unpack = np.zeros(SKETCH, np.uint8), zstandard.ZstdDecompressor().decompress
    for slot, _, counts in lanes.collect():  # SKETCH / SLICE rows
        got = np.frombuffer(unpack(counts, max_output_size=SLICE * 8), np.int64)
        out[slot * SLICE : (slot + 1) * SLICE] = np.minimum(255, 8 * np.log2(got + 1)).astype(np.uint8)
    return out


def _prefixes(size: int, threshold: int, seed: int, levels):
    """Step 3: (token, node, pos, n) of each text's rarest n-grams."""

    def run(batches):
        level = levels.value
        for batch in batches:
            for _, data, offsets in text_chunks(batch, "text"):
                words, first = word_hashes(data, offsets, seed)
                token, node, pos, n = [], [], [], []
                for i, s in enumerate(ngram_sets(words, first, size)):
                    if k := len(s):
                        p = k - -(-threshold * k // 100) + 1
                        rare = np.argsort(level[s & np.uint64(SKETCH - 1)], kind="stable")[:p]
                        token.append(s[rare].view(np.int64))
                        node.append(np.full(p, node_of(words[first[i] : first[i + 1]])[0]))
                        pos.append(np.arange(p, dtype=np.int32))
                        n.append(np.full(p, k, np.int32))
                if token:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (token, node, pos, n)], ["token", "node", "pos", "n"])

    return run


def _verify(pairs: DataFrame, nodes: DataFrame, sets: WholeSets, threshold: int) -> DataFrame | None:
    """Of distinct pairs (a, b) those that link: the suffix filter on histograms, then the whole sets, once a pair."""
    h = nodes.select("node", "n", "bins")
    near = (
        pairs.join(h.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bins").alias("ba")), "a")
        .join(h.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bb")), "b")
        .where(F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x) * (100 + threshold) >= (F.col("na") + F.col("nb")) * threshold)
        .select("a", "b", "na", "nb")
    )
    return sets.linked(materialise(near), threshold)


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: int = 80) -> DataFrame:
    """Rows ``(id_col, n_shingles, component_id)``, one for each row of ``docs``.

    ``n_shingles`` is the size of the row's n-gram set and ``component_id`` the smallest id that is reachable over
    links, the row itself included. A null or empty text, or one without words, has no set and links with nothing: its
    component is itself. Equal texts are one node, so repeated rows and copies link without being expanded into pairs.
    Very long texts are hashed whole: a worker holds one such text and about 20 bytes for each of its characters. A text with fewer than ``size`` words has one n-gram, the whole sequence. Null ids keep their row; a null is never
    a component's smallest id unless all ids of it are null. Other columns of ``docs`` are not read. An empty table
    gives no rows.
    """
    spark, seed = docs.sparkSession, 0
    text_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    while True:
        out = materialise(
            docs.mapInArrow(_profile(size, seed), f"doc_id {kind}, node long, chk long, n int, bins array<int>, sig array<long>, slot int, counts binary")
            .withColumn("lane", F.spark_partition_id() % 64)
        )
        rows = out.where("slot is null")
        nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("chk").alias("c"), F.max("chk").alias("d"), F.first("n").alias("n"), F.first("bins").alias("bins"), F.first("sig").alias("sig"))
        nodes = materialise(nodes)
        if nodes.where("c <> d").isEmpty():  # no two word sequences share a node
            break
        seed += 1
    levels = spark.sparkContext.broadcast(_levels(out.where("slot is not null").select("slot", "lane", "counts")))
    text = docs.where("text is not null").select("text")
    posted = materialise(text.mapInArrow(_prefixes(size, threshold, seed, levels), "token long, node long, pos int, n int"))
    levels.unpersist()
    shared = posted.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("token")
    # the text with the fewest rarer n-grams leads, as it has least of its own
    every, posted = posted, materialise(posted.join(shared, "token").distinct().withColumn("lead", -F.col("pos").cast("double")))
    discard(every)

    sets = WholeSets(docs, nodes, size, seed)
    links = star_links(posted, nodes.select("node", "sig"), lambda pairs: _verify(pairs, nodes, sets, threshold), threshold)
    return component_rows(rows, nodes, links, id_col)
