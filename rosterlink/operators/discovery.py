"""Discovery and validation of member-list seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.functions.dom import parsed_pages
from rosterlink.functions.text import key_title, legislature_number, underscored
from rosterlink.operators.members import validate_member_list
from rosterlink.sources.readers import latest, latest_pages
from rosterlink.sources.written import materialise

UNREADABLE = "Page could not be read"


def numbered_hits(hits: DataFrame) -> DataFrame:
    """The first hit of each title over all parliaments, of those that carry a legislature number."""
    rows = hits.withColumn("number", legislature_number(F.col("title"), F.col("snippet"))).where("number is not null")
    first = Window.partitionBy("title").orderBy("landtag_pos", "query_pos", "result_pos")
    return rows.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


def check_titles(hits: DataFrame, page_revisions: DataFrame, pages: DataFrame, registry: DataFrame) -> DataFrame:
    """Every numbered title of the search hits (``landtag_key, query_pos, result_pos, title, snippet``), checked once and written.

    Titles are taken by parliament, number and title (``ord``). A title without a page, or with a page that has no member
    list, has a ``reason``; ``first_valid`` is the place of its page's first valid title. Of several revisions of a title
    the latest counts.
    """
    r = registry.select("landtag_pos", "landtag_key", "key_prefix", "state", "parliament")
    rows = materialise(numbered_hits(hits.join(r, "landtag_key")).withColumn("t", underscored(F.col("title"))))
    info = page_revisions.select(underscored(F.col("page_title")).alias("t"), "page_id", "revision_id").where("page_id is not null")
    rows = rows.join(latest(info, ["t"], ["revision_id", "page_id"]), "t", "left")
    wanted = rows.where("page_id is not null").select(F.col("t").alias("page_title")).distinct()
    stored = pages.withColumn("page_title", underscored(F.col("page_title"))).join(wanted, "page_title", "left_semi")
    if {"retrieved_at", "revision_id"} & set(stored.columns):
        stored = latest_pages(stored)
    checked = parsed_pages(stored.select(F.col("page_title").alias("t"), "html"))
    checked = checked.select("t", validate_member_list(F.col("dom")).alias("check")).dropDuplicates(["t"])
    rows = rows.join(checked, "t", "left")
    reason = F.when(F.col("page_id").isNull(), "Page not found").when(F.col("check").isNull(), UNREADABLE).otherwise(F.col("check.reason"))
    rows = rows.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull()).withColumn("ord", F.struct("landtag_pos", "number", "title"))
    first_valid = F.min(F.when(F.col("valid"), F.col("ord"))).over(Window.partitionBy("page_id"))
    return materialise(rows.withColumn("first_valid", F.when(F.col("page_id").isNotNull(), first_valid)).drop("check", "t"))


_CHOSEN = "valid and ord = first_valid"
_REJECTED = "not valid and (first_valid is null or ord < first_valid)"


def seeds_of(checked: DataFrame, pin: bool = False) -> DataFrame:
    """Seeds of checked titles: of several titles of one page the first valid one, and the last title of a key."""
    seeds = checked.where(_CHOSEN).withColumn("key", F.concat("key_prefix", F.col("number").cast("string")))
    last = Window.partitionBy("key").orderBy(F.col("ord").desc())
    seeds = seeds.withColumn("rn", F.row_number().over(last)).where("rn = 1")
    ids = ["page_id", "revision_id"] if pin else []
    return seeds.select("key", F.col("title").alias("page_title"), key_title(F.col("title")).alias("title_key"), F.lit("").alias("expected_start"), F.lit("").alias("expected_end"), "parliament", "state", F.col("number").alias("legislature_number"), *ids)


def rejected_of(checked: DataFrame) -> DataFrame:
    """Titles that are no seed and the reason; titles after the first valid one of their page are passed over."""
    return checked.where(_REJECTED).select("landtag_key", "title", "number", "page_id", "reason")


def discover_seeds(hits: DataFrame, page_revisions: DataFrame, pages: DataFrame, registry: DataFrame, pin: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(seeds, rejected)`` of ``check_titles``."""
    checked = check_titles(hits, page_revisions, pages, registry)
    return seeds_of(checked, pin), rejected_of(checked)


def discovery_summary(checked: DataFrame) -> DataFrame:
    """``(what, n)``, from one pass over the checked titles: found, validated, rejected, errors (unreadable pages), seed_count."""
    key = F.when(F.expr(_CHOSEN), F.concat("key_prefix", F.col("number").cast("string")))
    n = checked.agg(
        F.count("*").alias("found"), F.count_if(F.expr(_CHOSEN)).alias("validated"), F.count_if(F.expr(_REJECTED)).alias("rejected"),
        F.count_if(F.expr(_REJECTED) & (F.col("reason") == UNREADABLE)).alias("errors"), F.countDistinct(key).alias("seed_count"),
    )
    what = ["found", "validated", "rejected", "errors", "seed_count"]
    return n.select(F.inline(F.array(*(F.struct(F.lit(w).alias("what"), F.col(w).alias("n")) for w in what))))


def validate_seeds(seeds: DataFrame) -> DataFrame:
    """``(seed_pos, key, problem)`` for every broken rule of seed rows (``map_key`` is the key the seed is listed under)."""
    n = F.count("*").over(Window.partitionBy("key"))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rules = [
        (empty("key"), "Missing field: key"), (empty("page_title"), "Missing field: page_title"),
        (F.col("expected_start").isNull() & F.col("expected_end").isNull(), "Missing field: expected_time_range"),
        (F.col("key") != F.col("map_key"), "Key mismatch"), ((n > 1) & ~empty("key"), "Duplicate seed key"),
        (F.col("expected_start").isNull() != F.col("expected_end").isNull(), "Time range needs start and end"),
    ]
    found = F.array_compact(F.array(*(F.when(rule, F.lit(message)) for rule, message in rules)))
    return seeds.withColumn("p", found).select("seed_pos", "key", F.explode("p").alias("problem"))
