"""Search documents and facet filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.text import page_url
from rosterlink.sources.readers import latest


def person_documents(persons: DataFrame) -> DataFrame:
    return persons.select("*", F.col("person_id").alias("_id"))


def mandate_documents(mandates: DataFrame) -> DataFrame:
    return mandates.select("*", F.col("mandate_id").alias("_id"))


def canonical_documents(canonical: DataFrame, metadata: DataFrame) -> DataFrame:
    """Canonical persons with their sources and provenance: their own where the table has it, else that of their page.

    A page's provenance names the revision that was read; persons without a stored page have none.
    """
    m = latest(metadata, ["page_title"], ["retrieved_at", "revision_id"])
    url = page_url(F.col("page_title"), F.col("revision_id")).alias("source_url")
    m = m.select(F.col("page_title").alias("t"), F.struct("revision_id", "page_id", "retrieved_at", "sha256", url).alias("of_page"))
    rows = canonical.join(m, F.col("identifiers.wikipedia_title") == F.col("t"), "left")
    sources = F.struct("identifiers.wikipedia_title", "identifiers.dip_person_id")
    provenance = F.coalesce("provenance", "of_page") if "provenance" in canonical.columns else F.col("of_page")
    return rows.select(F.col("id").alias("_id"), "display_name", sources.alias("sources"), F.lit("accepted").alias("match_status"), "evidence_ids", provenance.alias("provenance"))


#: What mandate documents are filtered by.
MANDATE_FACETS = ("person_id", "legislature_id", "party_name", "wahlkreis", "start_date", "end_date", "role")


def _where(rows: DataFrame, facets: dict) -> DataFrame:
    for name, value in facets.items():
        rows = rows.where(F.col(name) == value)
    return rows


def facet_mandates(mandates: DataFrame, **facets: str) -> DataFrame:
    """Mandate documents by ``MANDATE_FACETS``."""
    if unknown := set(facets) - set(MANDATE_FACETS):
        raise ValueError(f"no facets of mandates: {sorted(unknown)}")
    return _where(mandates, facets)


def facet_persons(persons: DataFrame, mandates: DataFrame, legislatures: DataFrame, **facets: str | int) -> DataFrame:
    """Persons by facets of their mandates and legislatures (party_name, parliament, state, number, start_date, end_date, role, wahlkreis)."""
    rows = mandates.join(legislatures.select("legislature_id", "parliament", "state", "number"), "legislature_id", "left")
    return persons.join(_where(rows, facets).select("person_id").distinct(), "person_id", "left_semi")
