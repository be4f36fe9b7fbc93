"""Members and person pages to entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.ids import bound, legislature_id, party_id, strip
from rosterlink.functions.text import page_url
from rosterlink.operators.members import EVIDENCE_REF
from rosterlink.sources.readers import latest
from rosterlink.sources.written import materialise

REFS = f"array<{EVIDENCE_REF}>"


def _last(*cols: str):
    """The values of the group's last row (largest seed and row position), pre-aggregated before the shuffle."""
    return F.max_by(F.struct(*cols), F.struct("seed_pos", "row_index")).alias("v")


def distinct_refs(refs: Column) -> Column:
    """An array of references in order, distinct but for their time: the first of equal ones stays.

    Sorted, equal ones are neighbours, as the time is a reference's last field.
    """
    same = lambda a, b: a["evidence_id"].eqNullSafe(b["evidence_id"]) & a["snippet_ref"].eqNullSafe(b["snippet_ref"]) & a["purpose"].eqNullSafe(b["purpose"])
    return bound(F.array_sort(refs), lambda s: F.filter(s, lambda r, i: (i == 0) | ~same(r, F.get(s, i - 1))))


def merge_persons(members: DataFrame) -> DataFrame:
    """One row a person: values of the last row, the evidence ids and row references of all rows.

    Rows move once; references and ids that are equal meet before that.
    """
    rows = members.groupBy("person_id").agg(
        _last("name", "wikipedia_title", "wikipedia_url"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("evidence_ids")))).alias("evidence_ids"),
        F.flatten(F.collect_set("evidence_refs")).alias("refs"),
    )
    return rows.select("person_id", "v.*", "evidence_ids", distinct_refs(F.col("refs")).alias("evidence_refs"))


def enrich_persons(persons: DataFrame, person_pages: DataFrame) -> DataFrame:
    """Persons with what their page says, written once; a missing page keeps the person and the references of its rows.

    References are those of the page, then those of the list rows that name the person. A person is ``enriched`` if the
    page gives a date or an intro; a page that says nothing, or only that there is no birth date, enriches nobody.
    """
    p = person_pages.select(F.col("wikipedia_title").alias("t"), F.col("evidence_id").alias("page_evidence_id"), "birth_date", "birth_date_status", "death_date", "intro", F.col("evidence_refs").alias("page_refs"), "unstructured_evidence", "data_quality_flags")
    rows = persons.withColumnRenamed("evidence_refs", "row_refs")
    rows = rows.join(p, rows["wikipedia_title"] == p["t"], "left").drop("t")
    none, no_refs = F.array().cast("array<string>"), F.array().cast(REFS)
    # a page has one reference and rows have theirs distinct, so only equal ones of both are left to drop
    key = lambda r: F.struct(r["evidence_id"], r["purpose"], r["snippet_ref"])
    of_page = F.coalesce("page_refs", no_refs)
    others = F.filter(F.coalesce("row_refs", no_refs), lambda r: ~F.array_contains(F.transform(of_page, key), key(r)))
    rows = rows.withColumn("evidence_refs", F.concat(of_page, others))
    said = [F.col(c).isNotNull() for c in ("birth_date", "death_date", "intro")]
    return materialise(rows.withColumns({
        "page_found": F.col("page_evidence_id").isNotNull(), "enriched": said[0] | said[1] | said[2], "birth_date_status": F.coalesce("birth_date_status", F.lit("unknown")),
        "evidence_ids": F.array_sort(F.array_union("evidence_ids", F.transform("evidence_refs", lambda r: r["evidence_id"]))),
        "data_quality_flags": F.array_sort(F.array_distinct(F.coalesce("data_quality_flags", none))),
    }).drop("page_evidence_id", "page_refs", "row_refs"))


def parties(members: DataFrame) -> DataFrame:
    """The first spelling of each party."""
    rows = members.where("party_name <> ''").withColumn("party_id", party_id(F.col("party_name")))
    first = F.min_by(F.struct("party_name", "evidence_ids"), F.struct("seed_pos", "row_index")).alias("v")
    return rows.groupBy("party_id").agg(first).select("party_id", F.col("v.party_name").alias("name"), "v.evidence_ids")


def legislatures(seeds: DataFrame) -> DataFrame:
    """Legislatures of the seeds that name parliament, state and number."""
    rows = seeds.where("length(parliament) > 0 and length(state) > 0 and legislature_number <> 0")
    rows = rows.select(legislature_id(F.col("parliament"), F.col("state"), F.col("legislature_number")).alias("legislature_id"), "parliament", "state", F.col("legislature_number").alias("number"), F.col("expected_start").alias("start_date"), F.col("expected_end").alias("end_date"), "seed_pos")
    return latest(rows, ["legislature_id"], ["seed_pos"]).drop("seed_pos")


def mandates(members: DataFrame) -> DataFrame:
    """One row a mandate: values of the last row, the references of all rows."""
    cols = ["person_id", "legislature_id", "party_name", "wahlkreis", "start_date", "end_date", "role", "notes", "events"]
    rows = members.groupBy("mandate_id").agg(_last(*cols), F.array_sort(F.array_distinct(F.flatten(F.collect_set("evidence_refs")))).alias("evidence_refs"))
    return rows.select("mandate_id", "v.*", "evidence_refs", F.array_sort(F.array_distinct(F.transform("evidence_refs", lambda r: r["evidence_id"]))).alias("evidence_ids"))


def evidence(parsed: DataFrame, retrieved_at: str = "") -> DataFrame:
    """Page-level evidence of the parsed list pages (one row an id: all of an id's values are equal); row references never go here."""
    rows = parsed.where("error is null").select("evidence_id", F.lit("mediawiki").alias("source_kind"), "page_title", "page_id", "revision_id", "sha256", page_url(F.col("page_title"), F.col("revision_id")).alias("source_url"), F.lit(retrieved_at).alias("retrieved_at"))
    return rows.dropDuplicates(["evidence_id"])


def quality_warnings(persons: DataFrame) -> DataFrame:
    return persons.where("intro is not null and size(evidence_ids) < 2").select("person_id", "wikipedia_title", F.size("evidence_ids").alias("n_evidence"))


def enrichment_stats(persons: DataFrame) -> DataFrame:
    """All persons, those that their page enriched, and those whose page is missing."""
    return persons.agg(F.count("*").alias("total"), F.count_if("enriched").alias("enriched"), F.count_if(~F.col("page_found")).alias("failed"))


def wiki_records(persons: DataFrame, metadata: DataFrame) -> DataFrame:
    """Person records for linking, with the provenance of their page; unknown page and revision ids are 0."""
    m = latest(metadata, ["page_title"], ["retrieved_at", "revision_id"]).select(F.col("page_title").alias("t"), "page_id", "revision_id", "retrieved_at", "sha256", page_url(F.col("page_title"), F.col("revision_id")).alias("source_url"))
    rows = persons.join(m, persons["wikipedia_title"] == m["t"], "left").drop("t")
    return rows.select(
        F.col("person_id").alias("id"), "wikipedia_title", "wikipedia_url", F.coalesce("page_id", F.lit(0)).alias("page_id"), F.coalesce("revision_id", F.lit(0)).alias("revision_id"), strip(F.col("name")).alias("name"),
        "birth_date", "death_date", "intro", "evidence_ids", F.struct("revision_id", "page_id", "retrieved_at", "sha256", "source_url").alias("provenance"),
    )
