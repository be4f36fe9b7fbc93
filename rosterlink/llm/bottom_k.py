"""MinHash near duplicates by bottom-k sketches from one hash function.

Every text is lower-cased (A-Z) and cut into words; its set is the distinct word n-grams, hashed by one function. A
text's *sketch* is the ``RETAINED`` smallest hashes of its set, so the smallest hashes of a union of two sets are found
from their sketches alone, and the share of them that both sets hold estimates the Jaccard similarity. The steps:

1. One pass sketches every text. Texts with equal word sequences are one *node*.
2. Inverted lists: retained values list the nodes that hold them, and nodes of a list overlap. Of two sets with a
   similarity of 0.8 or more the smallest ``RETAINED`` hashes of the union are shared by four in five, in random order: that
   fewer than ``SHARED`` are has a chance below 1e-10 a pair. So at least ``SHARED`` values are in both sketches, and it is
   enough to list a node under all but ``SHARED - 1`` of its values: the most frequent ones are left out, and a passage that
   many documents have in common lists none that holds enough else. (Sets of few values are listed by the exact bound.)
3. Candidates come from the lists by rounds of leaders, so a value that many texts hold does not give all their pairs.
4. The union sketch of a candidate pair drops it where fewer than ``SHARED`` of its values are in both sets (or less than
   the threshold, where the sketches are whole sets).
5. The rest is verified by the exact Jaccard similarity of the whole sets, once a pair.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.common import discard, materialise, text_batches, text_chunks
from rosterlink.llm.shingles import ngram_sets, word_hashes
from rosterlink.llm.star_links import WholeSets, component_rows, node_of, signature, star_links

#: Values of a sketch, and those of a union sketch that two linked sets share at least.
RETAINED, SHARED = 64, 26


def _sketches(size: int, seed: int, retained: int):
    """A row for each text: node, size of its set, sketch and signature."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in text_chunks(batch, "text"):
                words, first = word_hashes(data, offsets, seed)
                node, check, sizes, sketch, sigs = [], [], [], [], []
                for i, s in enumerate(ngram_sets(words, first, size)):
                    a, b = node_of(words[first[i] : first[i + 1]])
                    node.append(a if len(s) else None)
                    check.append(b if len(s) else None)
                    sizes.append(len(s))
                    sketch.append((s[:retained] >> 1).tolist() if len(s) else None)  # the set is sorted; 63 bits have no sign
                    sigs.append(signature(s) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(node)), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sketch, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                    ["doc_id", "node", "chk", "n", "sketch", "sig"],
                )

    return run


def _listed(threshold: int, shared: int) -> Column:
    """How many values of a node's sketch list it: of ``held`` values, linked sets share all but one less than this."""
    few = F.col("held") - F.ceil(F.col("held") * threshold / 100) + 1
    return F.when(F.col("held") * threshold >= shared * 100, F.col("held") - shared + 1).otherwise(few)


def _verify(pairs: DataFrame, nodes: DataFrame, sets: WholeSets, threshold: int, retained: int, shared: int) -> DataFrame | None:
    """Of distinct pairs (a, b) those that link: first by the estimate of the union's sketch, then by the whole sets."""
    h = nodes.select("node", "n", "sketch")
    union = F.slice(F.array_sort(F.array_union("ka", "kb")), 1, retained)
    both = F.size(F.array_intersect(F.array_intersect("ka", "kb"), F.col("u")))
    # two sketches that are whole sets show the union whole, up to its own bound
    enough = F.when(F.size("u") < retained, both * 100 >= F.size("u") * threshold).otherwise(both >= shared)
    near = (
        pairs.join(h.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a")
        .join(h.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
        .withColumn("u", union).where(enough).select("a", "b", "na", "nb")
    )
    return sets.linked(materialise(near), threshold)


def bottom_k_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: int = 80, retained: int = RETAINED, shared: int = SHARED) -> DataFrame:
    """Rows ``(id_col, n_shingles, component_id)``, one for each row of ``docs``.

    ``n_shingles`` is the size of the row's set of ``size``-word shingles, ``component_id`` the smallest id reachable over
    links (``100 * |intersection| >= threshold * |union|``), the row itself included. ``retained`` and ``shared``
    are set for thresholds of 80 and more; lower ones need a smaller ``shared``.

    A null or empty text, or one without words, has no set and links with nothing; one with fewer than ``size`` words has
    one shingle, the whole sequence. Equal texts are one node, so repeated rows and copies link without being expanded into
    pairs. A very long text is hashed whole: a worker holds one such text and about 20 bytes for each of its characters.
    Null ids keep their row; a null is a component's smallest id only if all ids of it are null. Other columns of ``docs``
    are not read. An empty table gives no rows.
    """
    spark, seed = docs.sparkSession, 0
    text_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    while True:
        rows = materialise(docs.mapInArrow(_sketches(size, seed, retained), f"doc_id {kind}, node long, chk long, n int, sketch array<long>, sig array<long>"))
        nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("chk").alias("c"), F.max("chk").alias("d"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("sig").alias("sig"))
        nodes = materialise(nodes)
        if nodes.where("c <> d").isEmpty():  # no two word sequences share a node
            break
        seed += 1
    counts = nodes.select(F.explode("sketch").alias("token")).groupBy("token").agg(F.count("*").alias("k")).where("k > 1")
    # values of one node alone are the rarest and list nothing: of a node's others the rarest are taken
    common = materialise(nodes.select("node", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("token")).join(counts, "token"))
    of_node = common.groupBy("node", "n", "held").agg(F.array_sort(F.collect_list(F.struct("k", "token"))).alias("v"))
    left = F.greatest(F.lit(0), _listed(threshold, shared) - (F.col("held") - F.size("v"))).cast("int")
    of_node = materialise(of_node.select("node", "n", F.slice("v", F.lit(1), left).alias("v")).where(F.size("v") > 0))
    lead = F.aggregate("v", F.lit(0.0), lambda s, x: s + x["k"]) / F.size("v")
    posted = of_node.select("node", "n", lead.alias("lead"), F.lit(0).alias("pos"), F.explode("v.token").alias("token"))
    alone = posted.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    posted = materialise(posted.join(alone, "token").select("token", "node", "pos", "n", "lead"))
    discard(common)
    sets = WholeSets(docs, nodes, size, seed)
    signatures = nodes.select("node", "sig").join(of_node.select("node", F.col("v.token").alias("tokens")), "node")
    # a pair of the last round is made once here, so it may come early
    links = star_links(posted, signatures, lambda pairs: _verify(pairs, nodes, sets, threshold, retained, shared), threshold, best=8, few=200_000, near=0)
    return component_rows(rows.select("doc_id", "node", "n"), nodes, links, id_col)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``bottom_k_components`` plus ``kept``: the row's id is its component's (true for each row of one id, and without any)."""
    out = bottom_k_components(docs, id_col, **settings)
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
