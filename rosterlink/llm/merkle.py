"""Merkle manifest of a dataset: a tree of digests for each source and one over the sources, with a proof for each row.

A row's leaf is the digest of its columns. Within a source the leaves stand in order of their id, and every run of
``FAN`` consecutive nodes becomes the node above, until one is left: the source's *subroot*. The subroots in order of
their source are the leaves of a last tree, whose end is the *root*.

Every level is one window: the nodes' neighbours at fixed offsets, by ``lag`` and ``lead``, masked by a node's slot in its
run and by the run's length, are its siblings, and the rows in a run's first slot hash the run into the parent. No window
goes over a whole source. Rows get their places from ranges of (source, id), so a source that holds most rows lies in many
ranges, and windows are cut into blocks of ``FAN`` whole runs, which never share a sibling. Proofs come down from the root:
a block of nodes is joined with its ``FAN`` parents and each node puts its own siblings before its parent's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.llm.common import discard, materialise

#: Nodes of a run; rows of a range that gives places.
FAN, RANGE_ROWS = 16, 500_000
#: Columns that make a leaf, in this order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "left string, right string"


def digest(*values: str | Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the values, one after the other; a null is ``-``, others are length, ``:``, value.

    The length is that of the value's UTF-8 bytes, so no two rows of values look alike when they stand together.
    """

    def framed(value: str | Column) -> Column:
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, values)), 256)


def _ranges(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in ranges of ``group`` and ``order`` (which must tell all rows apart), and a row for each group of a range.

    A row's place in its group is ``__seq``, which counts within a range, plus the ``__shift`` of its group's part there:
    the rows of the group in the ranges before. ``n`` counts the rows of the group. Only parts meet in a window.
    """
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS)
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    # in a sorted range this id grows by one from row to row, and its upper bits number the range
    placed = materialise(placed.withColumn("__seq", F.monotonically_increasing_id()).withColumn("__range", F.shiftright("__seq", 33)))
    parts = placed.groupBy(*group, "__range").agg(F.min("__seq").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy(*group)
    before = F.sum("__rows").over(whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    shift = (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift")
    return placed, materialise(parts.select(*group, "__range", shift, before.isNull().alias("__head"), F.sum("__rows").over(whole).alias("n")))


def _numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with ``tree`` (the place of its group among all), ``pos`` and ``n`` in the place of the group; and the trees."""
    placed, parts = _ranges(leaves, ["grp"], ["id", "digest", "row"])
    groups, whole = _ranges(parts.where("__head").select("grp", F.lit(0).alias("all")), ["all"], ["grp"])
    trees = groups.join(whole, ["all", "__range"]).select("grp", (F.col("__seq") + F.col("__shift")).alias("tree"), F.col("n").alias("trees"))
    trees = materialise(trees)
    of = parts.join(trees.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(F.col("grp").alias("g"), F.col("__range").alias("r"), "__shift", "n", "tree")
    rows = placed.join(of, F.col("grp").eqNullSafe(F.col("g")) & (F.col("__range") == F.col("r")))
    out = materialise(rows.select("id", "tree", (F.col("__seq") + F.col("__shift")).alias("pos"), "n", "digest", "other"))
    discard(placed, parts, groups, whole)
    return out, trees.drop("grp")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, n, digest) plus ``block``, ``before`` and ``after``: digests of the run left and right of a node."""
    place = Window.partitionBy("tree", "block").orderBy("pos")
    slot, run = F.col("pos") % FAN, F.least(F.lit(FAN), F.col("n") - F.col("pos") + F.col("pos") % FAN)
    left = [F.when(slot >= k, F.lag("digest", k).over(place)) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("digest", k).over(place)) for k in range(1, FAN)]
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / (FAN * FAN)))
    return nodes.withColumns({"before": F.concat_ws("", *left), "after": F.concat_ws("", *right)})


def _parents(nodes: DataFrame) -> DataFrame:
    """The level above; trees that have come to one node are not in it."""
    first = _with_siblings(nodes.where("n > 1").select("tree", "pos", "n", "digest")).where(F.col("pos") % FAN == 0)
    return first.select("tree", F.floor(F.col("pos") / FAN).alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), F.sha2(F.concat("digest", "after"), 256).alias("digest"))


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Leaves, their parents, and so on up to the level where no tree has more than one node."""
    levels = [leaves]
    while not levels[-1].where("n > 1").isEmpty():
        levels.append(materialise(_parents(levels[-1])))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``(tree, digest)``: the last node of each tree."""
    return reduce(DataFrame.unionByName, (level.where("n = 1").select("tree", "digest") for level in levels))


def _proofs(nodes: DataFrame, above: DataFrame | None, tops: DataFrame) -> DataFrame:
    """``nodes`` plus ``subroot``, ``root`` and ``path``: an array of (left, right) digests from the node's level to the root.

    ``above`` has the paths of the level above, ``tops`` what lies over each tree: (tree, subroot, root, path).
    """
    alone = nodes.where("n = 1").join(tops, "tree")
    if above is None:
        return alone
    of_block = F.collect_list(F.struct("pos", "path")).alias("parents")
    blocks = above.groupBy("tree", F.floor(F.col("pos") / FAN).alias("block")).agg(F.first("subroot").alias("subroot"), F.first("root").alias("root"), F.array_sort(of_block).alias("parents"))
    parent = F.element_at("parents", (F.floor(F.col("pos") / FAN) % FAN + 1).cast("int"))["path"]
    own = F.array(F.struct(F.col("before").alias("left"), F.col("after").alias("right")))
    rest = _with_siblings(nodes.where("n > 1")).join(blocks, ["tree", "block"])
    return alone.unionByName(rest.withColumn("path", F.concat(own, parent)).select(*alone.columns))


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of the lowest level."""
    paths = None
    for level in levels[:0:-1]:
        below = materialise(_proofs(level, paths, tops))
        discard(paths)
        paths = below
    return _proofs(levels[0], paths, tops)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to by the siblings in ``path``."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", leaf_cols: tuple[str, ...] = LEAF, changed: dict[str, Column] | None = None) -> DataFrame:
    """Rows ``(id_col, leaf, subroot, root, path, candidate)``, one for each row of ``docs``.

    ``path`` holds the siblings from the leaf to the root, level by level, as (left, right) texts of concatenated digests;
    ``fold(leaf, path)`` is ``root``, and that of a leaf made from other values is not. ``candidate`` is the leaf of the row
    after ``changed`` (new values by column), the leaf itself where nothing changes.

    Nulls in any column have their own mark in a digest; rows without an id come first in their source and a null source
    is a source, the first. Rows of one id stand in order of their leaf; equal rows are leaves of their own with equal
    digests. An empty text is not a null one. Very long texts are hashed whole, where they are read, and never move: only
    digests do. Columns that are not in ``leaf_cols`` are not read. An empty table gives no rows.
    """
    now = [F.col(c) for c in leaf_cols]
    new = [(changed or {}).get(c, F.col(c)) for c in leaf_cols]
    differs = reduce(lambda x, c: x | ~F.col(c).eqNullSafe(changed[c]), changed or {}, F.lit(False))
    leaves = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), digest(*now).alias("digest"), F.when(differs, digest(*new)).alias("other"))
    leaves = materialise(leaves.withColumn("row", F.monotonically_increasing_id()))
    numbered, trees = _numbered(leaves)
    discard(leaves)
    levels = _levels(numbered)
    of_tree = _tops([level.select("tree", "n", "digest") for level in levels]).join(trees, "tree")
    upper = _levels(materialise(of_tree.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("n"), "digest")))
    none = F.array().cast(f"array<struct<{_STEP}>>")
    over = _tops(upper).select("tree", F.lit("").alias("subroot"), F.col("digest").alias("root"), none.alias("path"))
    tops = materialise(_descend(upper, over).select(F.col("pos").alias("tree"), F.col("digest").alias("subroot"), "root", "path"))
    out = _descend(levels, tops)
    return out.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path", F.coalesce("other", "digest").alias("candidate"))


def lower_case_tampered(id_col: str = "doc_id", text_col: str = "text", modulus: int = 5) -> Column:
    """The text, A-Z made lower-case where ``modulus`` divides the crc32 of the id as text."""
    return F.when(F.crc32(F.col(id_col).cast("string")) % modulus == 0, F.translate(text_col, UPPER, LOWER)).otherwise(F.col(text_col))
