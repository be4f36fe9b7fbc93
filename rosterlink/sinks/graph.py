"""The property graph as bulk node and edge tables, upserted by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.ids import party_id


def nodes(tables: dict[str, tuple]) -> DataFrame:
    """``(label, id, properties)`` of all tables: label to frame, id column and, optionally, columns that order its rows.

    The last row of an id stays: by the order given, else by ``updated_at`` or ``created_at``, and then, as where there is
    none of these, by the properties themselves. Rows without an id are no nodes.
    """
    out = None
    for label, (df, key, *given) in tables.items():
        order = list(given[0]) if given else [c for c in ("updated_at", "created_at") if c in df.columns]
        properties = F.to_json(F.struct(*[c for c in df.columns if c not in (given[0] if given else ())]))
        last = F.max(F.struct(*order, properties.alias("properties"))).alias("m")
        rows = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("id")).agg(last)
        rows = rows.select(F.lit(label).alias("label"), "id", "m.properties")
        out = rows if out is None else out.unionByName(rows)
    return out


def all_nodes(tables: dict[str, DataFrame], stubs: DataFrame | None = None) -> DataFrame:
    """Nodes of all nine labels from the entity tables of a run; evidence that is only cited is a stub with its id alone."""
    named = {
        "Person": ("persons", "person_id"), "Party": ("parties", "party_id"), "Legislature": ("legislatures", "legislature_id"), "Mandate": ("mandates", "mandate_id"), "Evidence": ("evidence", "evidence_id"),
        "WikipediaPersonRecord": ("wiki_records", "id"), "DipPersonRecord": ("dip_records", "id"), "CanonicalPerson": ("canonical_persons", "id"), "PersonLinkAssertion": ("assertions", "id"),
    }
    out = nodes({label: (tables[name], key) for label, (name, key) in named.items()})
    return out if stubs is None else out.unionByName(nodes({"Evidence": (stubs, "evidence_id")}))


def node_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("label").agg(F.count("*").alias("n"))


def supported_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Edges from persons or mandates to evidence, distinct by (source, evidence, purpose, reference)."""
    rows = df.select(F.col(key).alias("src"), F.explode("evidence_refs").alias("r"))
    rows = rows.select("src", F.col("r.evidence_id").alias("dst"), F.coalesce("r.purpose", F.lit("")).alias("purpose"), F.coalesce(F.to_json("r.snippet_ref"), F.lit("")).alias("snippet_ref_json")).distinct()
    none = F.lit(None).cast("string")
    return rows.select(F.lit(label).alias("src_label"), "src", F.lit("SUPPORTED_BY").alias("type"), F.lit("Evidence").alias("dst_label"), "dst", "purpose", "snippet_ref_json", none.alias("start_date"), none.alias("end_date"))


def evidence_stubs(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence nodes that edges need and the evidence table does not have."""
    return edges.where("type = 'SUPPORTED_BY'").select(F.col("dst").alias("evidence_id")).distinct().join(evidence.select("evidence_id"), "evidence_id", "left_anti")


def _edge(rows: DataFrame, src_label: str, src: str, kind: str, dst_label: str, dst: Column, properties: tuple[str, ...] = (), order: list[str] | None = None) -> DataFrame:
    """One edge for each (source, target), with the ``properties`` of the row written last: by ``order``, then by their values."""
    ends = [F.col(src).alias("src"), dst.alias("dst")]
    last = F.max(F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order or [])), *(properties or (F.lit(0).alias("none"),)))).alias("m")
    edges = rows.groupBy(*ends).agg(last)
    value = lambda c: (F.col(f"m.{c}") if c in properties else F.lit(None).cast("string")).alias(c)
    return edges.select(F.lit(src_label).alias("src_label"), "src", F.lit(kind).alias("type"), F.lit(dst_label).alias("dst_label"), "dst", F.lit("").alias("purpose"), F.lit("").alias("snippet_ref_json"), value("start_date"), value("end_date"))


def mandate_edges(mandates: DataFrame, persons: DataFrame, parties: DataFrame, legislatures: DataFrame, order: list[str] | None = None) -> DataFrame:
    """HELD, IN and AFFILIATED_WITH (with start and end dates), between nodes that are there.

    An edge is one for its source, type and target: a mandate that comes several times writes its edges again, and the dates
    of its last row stay, by the columns ``order`` (else ``updated_at`` or ``created_at`` where the table has them).
    """
    order = [c for c in ("updated_at", "created_at") if c in mandates.columns] if order is None else order
    held = _edge(mandates, "Person", "person_id", "HELD", "Mandate", F.col("mandate_id")).join(persons.select(F.col("person_id").alias("src")), "src", "left_semi")
    inside = _edge(mandates.where("legislature_id is not null"), "Mandate", "mandate_id", "IN", "Legislature", F.col("legislature_id")).join(legislatures.select(F.col("legislature_id").alias("dst")), "dst", "left_semi")
    with_party = _edge(mandates.where("party_name <> ''"), "Mandate", "mandate_id", "AFFILIATED_WITH", "Party", party_id(F.col("party_name")), ("start_date", "end_date"), order)
    with_party = with_party.join(parties.select(F.col("party_id").alias("dst")), "dst", "left_semi")
    return held.unionByName(inside).unionByName(with_party)


def link_edges(assertions: DataFrame, canonical: DataFrame, wiki: DataFrame, dip: DataFrame) -> DataFrame:
    """HAS_SOURCE from canonical persons and LINKS from assertions, to records of both registries.

    Registry ids are compared as text, so these edges exist for both registries.
    """
    w = wiki.select(F.col("id").alias("w_id"), F.col("wikipedia_title").alias("w_title"))
    d = dip.select(F.col("id").alias("d_id"), F.col("dip_person_id").cast("string").alias("d_ref")).distinct()
    source_w = canonical.join(w, F.col("identifiers.wikipedia_title") == F.col("w_title"))
    source_d = canonical.join(d, F.col("identifiers.dip_person_id") == F.col("d_ref"))
    links_w = assertions.join(w, F.col("wikipedia_person_ref") == F.col("w_id"))
    links_d = assertions.join(d, F.col("dip_person_ref") == F.col("d_ref"))
    return (
        _edge(source_w, "CanonicalPerson", "id", "HAS_SOURCE", "WikipediaPersonRecord", F.col("w_id"))
        .unionByName(_edge(source_d, "CanonicalPerson", "id", "HAS_SOURCE", "DipPersonRecord", F.col("d_id")))
        .unionByName(_edge(links_w, "PersonLinkAssertion", "id", "LINKS", "WikipediaPersonRecord", F.col("w_id")))
        .unionByName(_edge(links_d, "PersonLinkAssertion", "id", "LINKS", "DipPersonRecord", F.col("d_id")))
    )
