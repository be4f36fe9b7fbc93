"""Preference formatting: a chosen and a rejected conversation as one prompt and two masked completions.

The longest common turn prefix of both (equal roles and texts, turn by turn) is rendered once as the prompt. What
follows is each branch's completion; its mask says which characters are trained on: those of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.llm.common import materialise

#: The frame around a rendered turn.
BEGIN, BREAK, END = "<|im_start|>", "\n", "<|im_end|>\n"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), turn["role"], F.lit(BREAK), turn["text"], F.lit(END))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """``start-end`` spans (code points, end excluded) of what assistant turns say, with their closing mark."""
    def add(s: Column, t: Column) -> Column:
        head = F.length(F.concat(F.lit(BEGIN), t["role"], F.lit(BREAK)))
        here = F.length(_rendered(t))
        span = F.concat((s["at"] + head).cast("string"), F.lit("-"), (s["at"] + here).cast("string"))
        return F.struct((s["at"] + here).alias("at"), F.when(t["role"] == "assistant", F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, start, add, lambda s: s["spans"]), ",")


def _formatted(both: DataFrame) -> DataFrame:
    """``both``: one row a pair, its sides ``c`` and ``r`` arrays of turns in order."""
    same = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_difference = F.array_position(same, F.lit(False)).cast("int")
    n = F.when(first_difference > 0, first_difference - 1).otherwise(F.size(same))
    cut = both.withColumn("n", n).select(
        "pair", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c")).alias("c"), F.slice("r", F.col("n") + 1, F.size("r")).alias("r"),
    )
    return cut.select(
        "pair", F.col("n").alias("n_prompt_turns"), _text(F.col("p")).alias("prompt"),
        _text(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_mask"), _text(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_mask"),
    )


def _turn(turn: str, role: str, text: str) -> Column:
    return F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows ``(pair_col, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask)``, one a pair.

    ``chosen`` and ``rejected`` hold one row a turn. Turns are put in order of ``turn_col``, ties by role and text; null
    roles and texts are empty; rows with a null pair are dropped, as they belong to no pair; repeated rows are repeated
    turns. A pair that only one side has gets an empty other completion. Equal conversations are all prompt with empty
    completions; no common first turn gives an empty prompt. Other columns are not read. A conversation becomes one
    training example and so one row, however long its texts. Empty tables give no rows.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(pair_col).isNotNull()).select(F.col(pair_col).alias("pair"), F.lit(name).alias("side"), _turn(turn_col, role_col, text_col).alias("t"))

    both = side(chosen, "c").unionByName(side(rejected, "r")).groupBy("pair").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "c", F.col("t")))).alias("c"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "r", F.col("t")))).alias("r"),
    )
    return _formatted(both).withColumnRenamed("pair", pair_col)


def other_answer_preferences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Preference pairs from conversations alone: rows of ``format_preferences`` and ``paired``, one a conversation.

    Chosen is the whole conversation. Rejected is the same up to one of its answers (assistant turns), in whose place
    stands an answer of another conversation, and ends there. Of k answers, that with number ``id mod k`` branches off.
    The distinct texts of all branching answers stand in one ring, in order of their SHA-256, and each is rejected in
    favour of the one before: so a rejected answer always differs from the chosen one, if there are two. A conversation
    without an answer is all prompt and not ``paired``.

    Turns are put in order of ``turn_col``, ties by role and text, and none is left out. Rows without a conversation id
    are dropped. Ids are whole numbers. Repeated rows are repeated turns; other columns are not read; an empty table
    gives no rows. Conversations move once; then only digests do, in range partitions, of which the driver sees the first
    and last digest each. A text that many conversations share is one row of the ring.
    """
    of = turns.where(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("pair")).agg(F.array_sort(F.collect_list(_turn(turn_col, role_col, text_col))).alias("c"))
    places = F.filter(F.transform("c", lambda t, i: F.when(t["role"] == "assistant", i)), lambda i: i.isNotNull())
    of = of.withColumn("places", places)
    branch = F.when(F.size("places") > 0, F.get("places", F.pmod(F.col("pair"), F.greatest(F.size("places"), F.lit(1))).cast("int")))
    of = of.withColumn("branch", branch).withColumn("said", F.get("c", F.col("branch"))["text"])
    of = materialise(of.select("pair", "c", "branch", F.sha2("said", 256).alias("digest"), "said"))

    ring = materialise(of.where("digest is not null").groupBy("digest").agg(F.first("said").alias("said")).repartitionByRange("digest").withColumn("part", F.spark_partition_id()))
    ends = sorted((r.part, r.a, r.z) for r in ring.groupBy("part").agg(F.min("digest").alias("a"), F.max("digest").alias("z")).collect())
    over = ring.sparkSession.createDataFrame([(z, ends[(k + 1) % len(ends)][1]) for k, (_, _, z) in enumerate(ends)], "digest string, first string")
    within = ring.select("digest", F.lead("digest").over(Window.partitionBy("part").orderBy("digest")).alias("after"))
    after = within.join(F.broadcast(over), "digest", "left").select("digest", F.coalesce("after", "first").alias("after"))
    other = after.join(ring.select(F.col("digest").alias("after"), F.col("said").alias("other")), "after").select("digest", "other")
    both = of.join(other, "digest", "left")
    answer = F.array(F.struct(F.get("c", F.col("branch"))["turn"].alias("turn"), F.lit("assistant").alias("role"), F.col("other").alias("text")))
    both = both.select("pair", "c", F.when(F.col("other").isNull(), F.col("c")).otherwise(F.concat(F.slice("c", F.lit(1), F.coalesce("branch", F.lit(0))), answer)).alias("r"))
    return _formatted(both).withColumn("paired", (F.col("chosen") != "") & (F.col("rejected") != "")).withColumnRenamed("pair", conv_col)
