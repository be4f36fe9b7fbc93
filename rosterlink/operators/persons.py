"""Person pages: intro, birth and death dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.dom import with_dom
from rosterlink.functions.ids import bound, evidence_id, person_id, strip
from rosterlink.functions.text import BASE_URL, parse_date, underscored
from rosterlink.operators.members import EVIDENCE_REF
from rosterlink.sources.readers import page_sha256
from rosterlink.sources.written import materialise


def intro(dom: Column) -> Column:
    return F.array_join(F.filter(dom["intro_parts"], lambda t: ~t.startswith("Koordinaten")), "\n\n")


def key_facts(dom: Column) -> Column:
    """``struct(birth_date, birth_date_status, death_date)`` of the first infobox; the last row that says so counts."""
    box = F.get(F.filter(dom["tables"], lambda t: t["cls"].rlike("infobox|biografie")), F.lit(0))
    cell = lambda row, tag: F.get(F.filter(row, lambda c: c["tag"] == tag), F.lit(0))
    facts = F.transform(box["rows"], lambda r: F.struct(cell(r, "th").alias("th"), cell(r, "td").alias("td")))
    facts = F.transform(F.filter(facts, lambda f: f["th"].isNotNull() & f["td"].isNotNull()), lambda f: F.struct(F.lower(strip(f["th"]["text"])).alias("label"), f["td"].alias("td")))

    def found(facts: Column) -> Column:
        of_birth = lambda f: f["label"].contains("geburt") | f["label"].contains("geboren")
        born = F.filter(facts, of_birth)
        dates = F.transform(born, lambda f: F.coalesce(parse_date(f["td"]["bday"]), parse_date(f["td"]["time_datetime"])))
        died = F.filter(facts, lambda f: ~of_birth(f) & (f["label"].contains("tod") | f["label"].contains("gestorben") | f["label"].contains("verstorben")))
        ended = F.transform(died, lambda f: parse_date(F.coalesce(F.nullif(f["td"]["time_datetime"], F.lit("")), f["td"]["time_text"], f["td"]["text"])))
        return F.struct(dates.alias("dates"), ended.alias("ended"))

    def last(at: Column) -> Column:
        of = lambda c: F.get(c, F.size(c) - 1)
        status = F.when(F.size(F.coalesce(at["dates"], F.array())) == 0, "unknown").when(of(at["dates"]).isNotNull(), "extracted").otherwise("not_present")
        return F.struct(of(F.array_compact(at["dates"])).alias("birth_date"), status.alias("birth_date_status"), of(F.array_compact(at["ended"])).alias("death_date"))

    return bound(bound(facts, found), last)


def _keyed(pages: DataFrame, *more: str) -> DataFrame:
    """``(wikipedia_title, evidence_id)`` of pages and ``more`` of their columns."""
    return pages.select(underscored(F.col("page_title")).alias("wikipedia_title"), evidence_id(F.col("page_id"), F.col("revision_id"), F.lit("parse"), page_sha256(pages)).alias("evidence_id"), *more)


def person_page_ids(pages: DataFrame) -> DataFrame:
    """``(wikipedia_title, evidence_id)`` as ``person_facts`` has them, from the keys of pages alone: nothing is parsed."""
    return _keyed(pages)


def person_facts(pages: DataFrame) -> DataFrame:
    """``(wikipedia_title, evidence_id, intro, facts)`` of pages (``page_title, page_id, revision_id, sha256, html``), each parsed
    once; only the facts are written.

    Ids hold the page's stored hash, else that of its ``parse`` object (``parse_sha256``).
    """
    doms = with_dom(_keyed(pages, "html"))
    return materialise(doms.select("wikipedia_title", "evidence_id", intro(F.col("dom")).alias("intro"), key_facts(F.col("dom")).alias("facts")))


def parse_person_pages(pages: DataFrame, run_ts: str = "") -> DataFrame:
    """One person record a page, from its ``person_facts``."""
    return person_records(person_facts(pages), run_ts)


def person_records(rows: DataFrame, run_ts: str = "") -> DataFrame:
    """Person records of ``person_facts``."""
    has = F.col("intro") != ""
    note = F.struct(F.lit("intro").alias("type"), F.substring("intro", 1, 500).alias("text"), F.col("evidence_id"))
    ref = F.struct(F.col("evidence_id"), F.lit(None).alias("snippet_ref"), F.lit("person_page_intro").alias("purpose"), F.lit(None).alias("confidence"), F.lit(run_ts).alias("created_at")).cast(EVIDENCE_REF)
    missing = F.col("facts.birth_date").isNull()
    return rows.select(
        person_id(F.col("wikipedia_title")).alias("person_id"), "wikipedia_title", F.concat(F.lit(BASE_URL), "wikipedia_title").alias("wikipedia_url"),
        "facts.birth_date", "facts.birth_date_status", "facts.death_date", F.when(has, F.col("intro")).alias("intro"), "evidence_id",
        F.when(has, F.array(ref)).otherwise(F.array().cast(f"array<{EVIDENCE_REF}>")).alias("evidence_refs"),
        F.when(has, F.array(note)).otherwise(F.array().cast("array<struct<type:string,text:string,evidence_id:string>>")).alias("unstructured_evidence"),
        F.when(missing, F.array(F.lit("missing_birth_date"))).otherwise(F.array().cast("array<string>")).alias("data_quality_flags"),
    )
