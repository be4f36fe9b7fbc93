"""Links between sets that share a token, without all pairs of a token's sets.

What the joins of near duplicates have in common: sets (*nodes*) are posted under tokens, two sets that link share a
token, and the components of all links are wanted. In each *star round* every row of a token is paired with one of the
token's leaders, so that a node meets another one under each of its tokens. Linked nodes become one component, and tokens whose nodes are all in one component are done. When the pairs
left between different components are few, or no longer shrink, one job looks at all of them: large tokens are dealt over
many tasks, and a pair is dropped where it is made unless its sizes, positions and signatures allow a link. Only what is
left is written and verified on the whole sets, once a pair. So the components are those of all links; nothing is capped,
sampled or dropped, and tokens of many sets that never link take time but no space.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.common import discard, materialise, text_chunks
from rosterlink.llm.components import connected_components
from rosterlink.llm.shingles import ngram_sets, word_hashes

#: Leaders of a token after the first round; pairs a posted row that two rounds of leaders may leave for the round over all.
ANY, MANY = 32, 200
#: Bits of a signature; rows of a token that one task looks at in the last round, and tasks that share a token at most.
BITS, TASK_ROWS, TASKS = 1024, 1 << 11, 256
#: Whole sets are looked up by a broadcast of node ids up to this many (8 bytes each), else by a shuffle.
BROADCAST_IDS = 1_000_000


def node_of(words: np.ndarray) -> tuple[int, int]:
    """Two 64-bit halves of the hash of a word sequence."""
    h = xxhash.xxh3_128_intdigest(words.tobytes())
    return (h & (2**64 - 1)) - 2**63, (h >> 64) - 2**63


def signature(tokens: np.ndarray) -> list[int]:
    """The parity of the set's tokens on each of ``BITS`` bits, as 64-bit numbers.

    A token that only one of two sets holds turns one bit over, so two signatures differ in no more bits than their sets
    in tokens.
    """
    odd = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _possible(threshold: int) -> Column:
    """Length and positional filter for a shared token at positions i and j of sets of sizes ni and nj."""
    most = F.least(F.col("ni") - F.col("i"), F.col("nj") - F.col("j"))
    return (
        (F.least("ni", "nj") * 100 >= F.greatest("ni", "nj") * threshold)
        & (most * (100 + threshold) >= (F.col("ni") + F.col("nj")) * threshold)
    )


def _alike(threshold: int) -> Column:
    """Whether the signatures sx and sy of sets of sizes ni and nj differ in no more bits than linked sets may in tokens."""
    bits = reduce(lambda s, k: s + F.bit_count(F.col("sx")[k].bitwiseXOR(F.col("sy")[k])), range(BITS // 64), F.lit(0))
    return bits * (100 + threshold) <= (F.col("ni") + F.col("nj")) * (100 - threshold)


def _every_pair(open_: DataFrame, signatures: DataFrame, threshold: int) -> DataFrame:
    """Distinct pairs (a, b) of nodes of different components that share a token and may link.

    A pair is looked at from its smaller node. The rows of a large token are dealt over up to ``TASKS`` lanes, and the
    other side is repeated in each; two nodes of a token's main component never meet.
    """
    once = "tokens" in signatures.columns
    rows = open_.join(signatures, "node").withColumn("lanes", F.least(F.lit(TASKS), F.ceil(F.col("k") / TASK_ROWS)).cast("int"))
    part = lambda x, c, p, n, s, main: (F.col("node").alias(x), F.col("c").alias(c), F.col("pos").alias(p), F.col("n").alias(n), F.col("sig").alias(s), (F.col("c") == F.col("main")).alias(main))
    one = rows.select("token", F.pmod(F.xxhash64("node"), "lanes").cast("int").alias("lane"), *part("x", "cx", "i", "ni", "sx", "in_main"), *([F.col("tokens").alias("tx")] if once else []))
    two = rows.select("token", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), *part("y", "cy", "j", "nj", "sy", "main_too"), *([F.col("tokens").alias("ty")] if once else []))
    same = (one["token"] == two["token"]) & (one["lane"] == two["lane"])
    apart = (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & ~(F.col("in_main") & F.col("main_too"))
    like = _possible(threshold) & _alike(threshold)
    if once:  # each pair under the smallest token that both have
        return one.join(two, same & apart & like & (F.array_min(F.array_intersect("tx", "ty")) == one["token"])).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return one.join(two, same & apart & like).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def star_links(posted: DataFrame, signatures: DataFrame, verify: Callable[[DataFrame], DataFrame | None], threshold: int, best: int = 4, few: int = 20_000, near: int = 2) -> DataFrame | None:
    """Links (a, b) that connect all components, or None.

    ``posted`` has a row (token, node, pos, n, lead) for each token of a node: its place in the node's order of tokens and
    the node's size, such that linked sets share a token before which they share nothing, and how well the node would lead
    (larger is better). ``signatures`` has (node, sig) and, where nodes have a bounded number of tokens, all ``tokens`` that
    they are posted under.
    ``verify`` takes distinct pairs (a, b) and returns those that link, or None.

    ``best`` nodes that lead best are a token's leaders in the first round. All pairs are looked at when there are no more than
    ``few``, or ``near`` a posted row after the first round, or ``MANY`` a row after two; with more, rounds of leaders go on
    while the pairs halve. None of these changes the components.
    """
    total = posted.count()
    links, open_, last, turn = None, posted.withColumn("c", F.col("node")), None, 0
    # the sizes a partner may have, from the row's own size and position and from the sizes that share its token
    low = F.greatest(F.col("n") * threshold / 100, F.col("least"))
    high = F.least(F.col("n") * 100 / threshold, (F.col("n") - F.col("pos")) * (100 + threshold) / threshold - F.col("n"), F.col("most"))

    def verified(pairs: DataFrame) -> None:
        nonlocal links
        pairs = materialise(pairs)
        found = verify(pairs)
        discard(pairs)
        if found is not None:
            links = found if links is None else links.unionByName(found)

    while total:
        # rows of each token outside its largest component, times all its rows: the pairs that are left to look at
        by = open_.groupBy("token", "c").agg(F.count("*").alias("k"), F.min("n").alias("least"), F.max("n").alias("most"))
        by = by.groupBy("token").agg(F.sum("k").alias("k"), F.max("k").alias("m"), F.max_by("c", "k").alias("main"), F.min("least").alias("least"), F.max("most").alias("most"))
        before, open_ = open_, materialise(open_.join(by.where("k > m"), "token").where(low <= high + 1e-6).drop("least", "most"))
        discard(before)
        left = open_.agg(F.sum(F.when(F.col("c") != F.col("main"), F.col("k")))).first()[0] or 0
        if not left:
            break
        full = left <= few or turn >= 1 and left <= near * total or turn >= 2 and (left <= MANY * total or left > last / 2)
        last, turn = left, turn + 1
        if full:
            verified(_every_pair(open_, signatures, threshold))
            discard(open_)
            break
        # nodes are dealt to the leaders anew under each token and in each round
        leaders_of = F.least(F.lit(best if turn == 1 else ANY), F.greatest(F.lit(1), F.floor(F.col("k") / 2)))
        lane = lambda *by: F.pmod(F.xxhash64(*by, F.lit(turn)), leaders_of).alias("lane")
        one = open_.select("token", lane("node", "token"), F.col("node").alias("x"), F.col("c").alias("cx"), F.col("pos").alias("i"), F.col("n").alias("ni"))
        two = open_.select("token", lane("node"), F.col("node").alias("y"), F.col("c").alias("cy"), F.col("pos").alias("j"), F.col("n").alias("nj"), "lead")
        order = F.struct((F.col("lead") if turn == 1 else F.lit(0)).alias("o"), F.xxhash64("y", F.lit(turn)).alias("q"), "y", "cy", "j", "nj")
        leaders = two.groupBy("token", "lane").agg(F.max(order).alias("l")).select("token", "lane", "l.*")
        met = one.join(leaders, (one["token"] == leaders["token"]) & (one["lane"] == leaders["lane"]) & (F.col("cx") != F.col("cy")) & _possible(threshold))
        verified(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        before, open_ = open_, open_.drop("k", "m", "main")
        if links is not None:
            comp = connected_components(links, "a", "b", rounds=2)
            open_ = materialise(open_.drop("c").join(comp, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component"))
            discard(before)
    return links


def _whole(size: int, seed: int):
    """The whole set of each text, by node."""

    def run(batches):
        for batch in batches:
            for _, data, offsets in text_chunks(batch, "text"):
                words, first = word_hashes(data, offsets, seed)
                sets = [(node_of(words[first[i] : first[i + 1]])[0], s) for i, s in enumerate(ngram_sets(words, first, size)) if len(s)]
                if sets:
                    ends = np.cumsum([0] + [len(s) for _, s in sets]).astype(np.int32)
                    arrays = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([s.view(np.int64) for _, s in sets])))
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in sets], pa.int64()), arrays], ["node", "tokens"])

    return run


class WholeSets:
    """The whole sets of nodes, worked out when a pair that passed all filters first needs them.

    ``docs`` has (doc_id, text) and ``nodes`` one of the ids of each node.
    """

    def __init__(self, docs: DataFrame, nodes: DataFrame, size: int, seed: int):
        self.docs, self.nodes, self.run, self.have = docs.where("text is not null"), nodes, _whole(size, seed), None

    def of(self, need: DataFrame) -> DataFrame:
        if self.have is not None:
            need = need.join(self.have.select("node"), "node", "left_anti")
        need = materialise(need.join(self.nodes.select("node", "doc_id"), "node"))
        source, n = self.docs, need.count()
        if n and need.where("doc_id is null").isEmpty():
            ids = need.select("doc_id")
            source = source.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "doc_id", "left_semi")
        if n:
            got = source.select("text").mapInArrow(self.run, "node long, tokens array<long>").join(need.select("node"), "node", "left_semi")
            got = materialise(got.dropDuplicates(["node"]))
            self.have = got if self.have is None else self.have.unionByName(got)
        return self.have

    def linked(self, near: DataFrame, threshold: int) -> DataFrame | None:
        """Of pairs (a, b, na, nb), with the sizes of both sets, those that link; ``near`` is discarded."""
        if near.isEmpty():
            discard(near)
            return None
        whole = self.of(near.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        common = F.size(F.array_intersect("ta", "tb"))
        found = materialise(
            near.join(whole.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(whole.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
            .where(common * (100 + threshold) >= (F.col("na") + F.col("nb")) * threshold)
            .select("a", "b")
        )
        discard(near)
        return found


def component_rows(rows: DataFrame, nodes: DataFrame, links: DataFrame | None, id_col: str) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of rows (doc_id, node, n): the smallest id that links reach from a row's node."""
    comp = connected_components(links, "a", "b") if links is not None else rows.sparkSession.createDataFrame([], "node long, component long")
    best = nodes.select("node", "doc_id").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = best.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = best.join(least, "component").select("node", "component_id")
    return rows.join(of_node, "node", "left").select(F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
