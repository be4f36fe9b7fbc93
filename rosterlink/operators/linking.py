"""Linking of two person registries by a deterministic ruleset with manual overrides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.functions.ids import canonical_id, link_assertion_id
from rosterlink.functions.text import fold_umlauts, name_parts, normalize_name
from rosterlink.sources.written import materialise

RULESET = "ruleset_v1"


def wiki_keys(wiki: DataFrame) -> DataFrame:
    parts = name_parts(normalize_name("name"))
    return wiki.select(F.col("id").alias("wiki_id"), parts.alias("w")).select("wiki_id", F.col("w.first").alias("wf"), F.col("w.last").alias("wl"), F.col("w.middle").alias("wm"))


def dip_keys(dip: DataFrame) -> DataFrame:
    norm = lambda c: F.coalesce(normalize_name(c), F.lit(""))
    return dip.select("dip_person_id", "dip_pos", norm("vorname").alias("df"), norm("nachname").alias("dl"), norm("namenszusatz").alias("dm"))


def _equal(a: str, b: str):
    return (F.col(a) == F.col(b)) & (F.length(a) > 0)


def _folded(a: str, b: str):
    return (F.length(a) > 0) & (F.length(b) > 0) & (fold_umlauts(F.col(a)) == fold_umlauts(F.col(b)))


def score():
    """The sum in double precision and in this order, at most 1."""
    last = F.when(_equal("wl", "dl"), 0.5).when(_folded("wl", "dl"), 0.48).otherwise(0.0)
    first = F.when(_equal("wf", "df"), 0.45).when(_folded("wf", "df"), 0.43).otherwise(0.0)
    middle = F.when(_equal("wm", "dm"), 0.05).otherwise(0.0)
    return F.least(F.lit(1.0), last + first + middle)


def candidates(wiki: DataFrame, dip: DataFrame) -> DataFrame:
    """All pairs with a score of at least 0.5, by two equi-joins that lose none.

    0.5 needs equal folded surnames, or equal first names and equal middle parts: 0.45 + 0.05.
    """
    w = materialise(wiki_keys(wiki).withColumn("wk", fold_umlauts(F.col("wl"))))  # each name is normalised once
    d = materialise(dip_keys(dip).withColumn("dk", fold_umlauts(F.col("dl"))))
    by_last = w.where("wk <> ''").join(d.where("dk <> ''"), F.col("wk") == F.col("dk"))
    by_rest = w.where("wf <> '' and wm <> ''").join(d, (F.col("wf") == F.col("df")) & (F.col("wm") == F.col("dm")) & ((F.col("wk") != F.col("dk")) | (F.col("wk") == "")))
    pairs = by_last.unionByName(by_rest).withColumn("score", score()).where("score >= 0.5")
    return pairs.select("wiki_id", "dip_person_id", "dip_pos", "score")


#: Parts the text of a name key; normalised names have word characters and spaces only.
_BAR = "|"


def _name_keys(first: str, last: str, middle: str) -> Column:
    """Every set of name parts that a score of 0.5 or more can rest on, as texts: surname as it is or folded, with or without
    first name (as it is or folded) and middle part, or first name and middle part alone. Empty parts make no key."""
    f, l, m = F.col(first), F.col(last), F.col(middle)
    lasts, firsts, middles = {"L": l, "l": fold_umlauts(l)}, {"": None, "F": f, "f": fold_umlauts(f)}, {"": None, "M": m}
    sets = [(kl + kf + km, [vl, vf, vm]) for kl, vl in lasts.items() for kf, vf in firsts.items() for km, vm in middles.items()] + [("FM", [f, m])]

    def key(kind: str, parts: list) -> Column:
        parts = [p for p in parts if p is not None]
        there = reduce(lambda x, p: x & (F.length(p) > 0), parts, F.lit(True))
        return F.when(there, F.concat_ws(_BAR, F.lit(kind), *parts))

    return F.array_compact(F.array(*(key(kind, parts) for kind, parts in sets)))


def _first_three(rows: DataFrame, *by: str) -> DataFrame:
    """The first three rows of each group in the registry's order; a task sends on no more than three a group."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy("dip_pos"))).where("_rn <= 3").drop("_rn")


def best_candidates(wiki: DataFrame, dip: DataFrame) -> DataFrame:
    """``(wiki_id, dip_person_id, dip_pos, score, rn, best, second)``: the best three a record, with the best and second-best
    score (0 if alone); ties keep the registry's order. Scores below 0.5 are no candidates.

    Pairs of namesakes are never formed. A score depends on names alone, so equal names are one class on either side. A
    registry row that is among a name's best three shares a set of name parts with it, and no three earlier rows share that
    set, as they would score as much and come first. So the first three rows under each set of parts are enough: each name
    meets at most 39 rows, whatever the number of namesakes. Only the best three are expanded to the records of a class.
    """
    names = ["wf", "wl", "wm"]
    rows = _first_three(dip_keys(dip), "df", "dl", "dm")
    listed = _first_three(rows.withColumn("key", F.explode(_name_keys("df", "dl", "dm"))), "key")
    records = materialise(wiki_keys(wiki))
    met = records.select(*names).distinct().withColumn("key", F.explode(_name_keys("wf", "wl", "wm"))).join(listed, "key").drop("key")
    met = met.dropDuplicates([*names, "dip_pos"]).withColumn("score", score()).where("score >= 0.5")
    of_name, every = Window.partitionBy(*names).orderBy(F.col("score").desc(), "dip_pos"), Window.partitionBy(*names)
    top = met.withColumn("rn", F.row_number().over(of_name)).where("rn <= 3")
    top = top.withColumns({"best": F.max("score").over(every), "second": F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("score"))).over(every), F.lit(0.0))})
    return records.join(top, names).select("wiki_id", "dip_person_id", "dip_pos", "score", "rn", "best", "second")


def reconcile(wiki: DataFrame, dip: DataFrame, overrides: DataFrame | None = None, run_ts: str = "") -> tuple[DataFrame, DataFrame]:
    """``(assertions, canonical persons)``, from names that are scored once; assertions are written.

    A manual override decides for its title, if it names a person of the registry; one that names nobody of the
    registry gives no assertion at all. Others are accepted with a best score of 0.95 that leads by 0.05, else their
    best three are pending, or one pending assertion says there is no candidate. Every override but ``rejected`` accepts.
    """
    def assertion(rows: DataFrame) -> DataFrame:
        return rows.select(
            link_assertion_id(F.col("wiki_id"), F.col("dip_person_ref"), RULESET).alias("id"), F.col("wiki_id").alias("wikipedia_person_ref"), "dip_person_ref", F.lit(RULESET).alias("ruleset_version"),
            "method", F.col("score").cast("double").alias("score"), "status", "reason", "evidence_ids", F.lit(run_ts).alias("created_at"), "wikipedia_title", "name", "page_id", "dip_person_id",
        )

    none = F.array().cast("array<string>")
    if overrides is None:
        overrides = wiki.sparkSession.createDataFrame([], "wikipedia_title string, dip_person_id bigint, status string, reason string")
    o = overrides.where("dip_person_id is not null").select("wikipedia_title", F.col("dip_person_id").alias("dip_person_id"), F.col("status").alias("o_status"), F.col("reason").alias("o_reason"))
    whole = wiki.select(F.col("id").alias("wiki_id"), "wikipedia_title", "name", "page_id", F.col("evidence_ids").alias("we"))
    of_dip = materialise(dip.groupBy("dip_person_id").agg(F.min_by("evidence_ids", "dip_pos").alias("de")))
    forced = whole.join(o, "wikipedia_title").join(of_dip, "dip_person_id")
    forced = forced.select(
        "*", F.col("dip_person_id").cast("string").alias("dip_person_ref"), F.lit("override").alias("method"), F.lit(1.0).alias("score"), F.when(F.col("o_status") == "rejected", "rejected").otherwise("accepted").alias("status"),
        F.coalesce("o_reason", F.lit("Manual override")).alias("reason"), F.concat("we", "de").alias("evidence_ids"),
    )
    free = whole.join(o, "wikipedia_title", "left_anti")
    top = best_candidates(free.select(F.col("wiki_id").alias("id"), "name"), dip)
    accepted = (F.col("best") >= 0.95) & (F.col("best") - F.col("second") >= 0.05)
    rows = free.join(top, "wiki_id", "left").where(F.col("rn").isNull() | ~accepted | (F.col("rn") == 1))
    rows = rows.join(of_dip, "dip_person_id", "left")
    reason = F.when(F.col("rn").isNull(), "No candidate found with score >= 0.5").when(accepted, F.format_string("Unique match with score %.2f", "score")).otherwise(F.format_string("Ambiguous match: best=%.2f, second=%.2f", "best", "second"))
    ruled = rows.select(
        "*", F.coalesce(F.col("dip_person_id").cast("string"), F.lit("none")).alias("dip_person_ref"), F.lit("ruleset").alias("method"), F.when(F.coalesce(accepted, F.lit(False)), "accepted").otherwise("pending").alias("status"),
        reason.alias("reason"), F.concat("we", F.coalesce("de", none)).alias("evidence_ids"),
    ).withColumn("score", F.coalesce("score", F.lit(0.0)))
    every = materialise(assertion(forced).unionByName(assertion(ruled)))
    canonical = every.where("status = 'accepted'").select(
        canonical_id(F.col("wikipedia_title"), F.col("dip_person_id")).alias("id"), F.col("name").alias("display_name"),
        F.struct("wikipedia_title", F.col("page_id").cast("string").alias("wikipedia_page_id"), F.col("dip_person_id").cast("string").alias("dip_person_id")).alias("identifiers"),
        F.lit(run_ts).alias("created_at"), F.lit(run_ts).alias("updated_at"), "evidence_ids",
    )
    return every.drop("wikipedia_title", "name", "page_id", "dip_person_id"), canonical


def link_summary(assertions: DataFrame, canonical: DataFrame) -> DataFrame:
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    a = assertions.agg(of("accepted"), of("pending"), of("rejected"), F.count("*").alias("assertions"))
    return a.withColumn("k", F.lit(1)).join(canonical.agg(F.count("*").alias("canonical_persons")).withColumn("k", F.lit(1)), "k").drop("k")


def assertions_by_status(assertions: DataFrame) -> DataFrame:
    return assertions.groupBy("status").agg(F.count("*").alias("n")).orderBy("status")
