"""The whole job over all seeds at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlink.functions.text import underscored
from rosterlink.operators import linking, members, normalize, persons, registry
from rosterlink.sinks import export, graph, search
from rosterlink.sources import readers
from rosterlink.sources.keyed_table import KeyedTable
from rosterlink.sources.page_store import ORDER, PageStore, latest_keys, latest_of, pages_of
from rosterlink.sources.readers import complete_metadata, latest
from rosterlink.sources.written import materialise


def run_pipeline(raw_pages: DataFrame | PageStore, seeds: DataFrame, dip_persons: DataFrame, overrides: DataFrame | None = None, run_ts: str = "", run_id: str = "run") -> dict[str, DataFrame]:
    """All entity tables from stored pages (lists and person pages), seeds and registry persons.

    Each page is parsed once, each name normalised and scored once: what several tables read is written in between.
    Registry rows are deduplicated, so that a person of several terms does not count as ambiguous.
    """
    parsed = members.member_pages(raw_pages, seeds)
    rows = members.parse_member_lists(parsed, run_ts)
    merged = materialise(normalize.merge_persons(rows))
    return _tables(raw_pages, seeds, parsed, rows, enrich_from(merged, raw_pages, run_ts), dip_persons, overrides, run_ts, run_id)


def run_changed(raw_pages: DataFrame | PageStore, state: str, seeds: DataFrame, dip_persons: DataFrame, overrides: DataFrame | None = None, run_ts: str = "", run_id: str = "run", buckets: int = 64) -> dict[str, DataFrame]:
    """The tables of ``run_pipeline``, from the parse results that an earlier run left in the folder ``state`` and new pages.

    ``state`` keeps which response of each title was parsed, and its result: the member table of each seed, the facts of
    each person page. A page is read whole and parsed only if its last response is another one than was parsed before, or
    if a seed or person asks for it for the first time; a changed result replaces the old one where it is stored and leaves
    other folders alone. ``parsed_titles`` names what this run has parsed. The first run creates the state.
    """
    spark = seeds.sparkSession
    keys = latest_keys(raw_pages).select("page_title", F.to_json("order").alias("version"))
    of_seed = F.sha2(F.to_json(F.struct(*[c for c in seeds.columns if c not in ("page_id", "revision_id")])), 256)
    wanted = seeds.withColumns({"title": underscored(F.col("page_title")), "seed": of_seed})
    wanted = materialise(wanted.join(keys.withColumnRenamed("page_title", "title"), "title"))

    lists = _parsed_before(spark, f"{state}/lists")
    todo = wanted if lists is None else wanted.join(lists.rows().select(F.col("seed_key").alias("key"), "version", "seed"), ["key", "version", "seed"], "left_anti")
    todo = materialise(todo)
    fresh = members.member_pages(raw_pages, todo.select(*seeds.columns)).join(todo.select(F.col("key").alias("seed_key"), "version", "seed"), "seed_key")
    lists = _keep(lists, fresh, f"{state}/lists", "seed_key", buckets)
    current = wanted.select(F.col("key").alias("seed_key"), "version", "seed")
    parsed = materialise(lists.rows().join(current, ["seed_key", "version", "seed"], "left_semi").drop("version", "seed"))
    rows = members.parse_member_lists(parsed, run_ts)
    merged = materialise(normalize.merge_persons(rows))

    people = _parsed_before(spark, f"{state}/people")
    asked = materialise(merged.select("wikipedia_title").join(keys.withColumnRenamed("page_title", "wikipedia_title"), "wikipedia_title"))
    missing = materialise(asked if people is None else asked.join(people.rows().select("wikipedia_title", "version"), ["wikipedia_title", "version"], "left_anti"))
    fresh = persons.person_facts(latest_of(raw_pages, missing.select(F.col("wikipedia_title").alias("page_title")), members.page_columns(raw_pages)))
    people = _keep(people, fresh.join(missing, "wikipedia_title"), f"{state}/people", "wikipedia_title", buckets)
    facts = people.rows().join(asked, ["wikipedia_title", "version"], "left_semi").drop("version")
    enriched = normalize.enrich_persons(merged, persons.person_records(facts, run_ts))

    out = _tables(raw_pages, seeds, parsed, rows, enriched, dip_persons, overrides, run_ts, run_id)
    out["parsed_titles"] = todo.select(F.col("title").alias("page_title")).union(missing.select("wikipedia_title")).distinct()
    return out


def _parsed_before(spark: SparkSession, path: str) -> KeyedTable | None:
    about = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/about")
    there = about.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(about)
    return KeyedTable.open(spark, path) if there else None


def _keep(table: KeyedTable | None, fresh: DataFrame, path: str, key: str, buckets: int) -> KeyedTable:
    """The stored table with ``fresh`` results in it; created if there is none."""
    if table is None:
        return KeyedTable.write(fresh, path, key, buckets)
    table.upsert(fresh)
    return table


def _tables(raw_pages: DataFrame | PageStore, seeds: DataFrame, parsed: DataFrame, rows: DataFrame, people: DataFrame, dip_persons: DataFrame, overrides: DataFrame | None, run_ts: str, run_id: str) -> dict[str, DataFrame]:
    """All tables of a run from parsed lists, their members, and enriched persons."""
    table = pages_of(raw_pages)
    metadata = complete_metadata(latest(table.select(underscored(F.col("page_title")).alias("page_title"), "page_id", "revision_id", "retrieved_at", "sha256", "url"), ["page_title"], list(ORDER)))
    wiki = materialise(normalize.wiki_records(people, metadata))
    dip = materialise(registry.dip_records(registry.dedup_dip(dip_persons)))
    assertions, canonical = linking.reconcile(wiki, dip, overrides, run_ts)
    out = {
        "persons": people, "parties": normalize.parties(rows), "legislatures": normalize.legislatures(seeds), "mandates": materialise(normalize.mandates(rows)), "evidence": normalize.evidence(parsed, run_ts),
        "wiki_records": wiki, "dip_records": dip, "assertions": assertions, "canonical_persons": canonical, "errors": members.parse_errors(parsed), "quality_warnings": normalize.quality_warnings(people),
    }
    edges = graph.supported_by(out["persons"], "person_id", "Person").unionByName(graph.supported_by(out["mandates"], "mandate_id", "Mandate"))
    out["edges"] = edges.unionByName(graph.mandate_edges(out["mandates"], out["persons"], out["parties"], out["legislatures"])).unionByName(graph.link_edges(assertions, canonical, wiki, dip))
    out["evidence_stubs"] = graph.evidence_stubs(edges, out["evidence"])
    out["nodes"] = graph.all_nodes(out, out["evidence_stubs"])
    out["person_documents"], out["mandate_documents"], out["canonical_documents"] = search.person_documents(people), search.mandate_documents(out["mandates"]), search.canonical_documents(canonical, metadata)
    out["run_manifest"] = run_manifest(out, run_id, run_ts)
    return out


def enrich_from(merged: DataFrame, pages: DataFrame | PageStore, run_ts: str = "") -> DataFrame:
    """Persons (written) with what the last fetched page of their title says; only those pages are read whole and parsed."""
    wanted = latest_of(pages, merged.select(F.col("wikipedia_title").alias("page_title")), members.page_columns(pages))
    return normalize.enrich_persons(merged, persons.parse_person_pages(wanted, run_ts))


def run_manifest(tables: dict[str, DataFrame], run_id: str, run_ts: str) -> DataFrame:
    """One row a run: its counts of links, enriched persons and errors, and the rows of every entity."""
    links = linking.link_summary(tables["assertions"], tables["canonical_persons"])
    enriched = normalize.enrichment_stats(tables["persons"]).select(F.struct("*").alias("enrichment"))
    errors = tables["errors"].agg(F.array_sort(F.collect_list("seed_key")).alias("errors"))
    names = ("persons", "parties", "legislatures", "mandates", "evidence")
    counts = export.manifest({n: tables[n] for n in names}, run_id, run_ts).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("entity", "n")))).alias("entities"))
    row = links.select(F.struct("*").alias("links"))
    for part in (enriched, errors, counts):  # tables of one row each
        row = row.withColumn("k", F.lit(1)).join(part.withColumn("k", F.lit(1)), "k").drop("k")
    status = F.when(F.size("errors") > 0, "error").otherwise("success")
    return row.select(F.lit(run_id).alias("run_id"), F.lit(run_ts).alias("completed_at"), status.alias("status"), "errors", "enrichment", "links", "entities")


def run_from_files(spark: SparkSession, cache: str, registry_pages: str, seeds_file: str, overrides_file: str | None = None, run_ts: str = "", run_id: str = "run") -> dict[str, DataFrame]:
    """``run_pipeline`` on stored files: page responses with metadata, registry pages, seeds and overrides.

    The files are read once and kept as columns, so that what chooses pages reads keys alone; ``unreadable`` has the files
    that hold no JSON.
    """
    overrides = readers.load_overrides(spark, overrides_file) if overrides_file else None
    dip = readers.dip_persons(readers.read_dip_pages(spark, registry_pages))
    pages = materialise(readers.read_raw_pages(spark, cache))
    out = run_pipeline(pages, readers.load_seeds(spark, seeds_file), dip, overrides, run_ts, run_id)
    return out | {"unreadable": readers.read_errors(spark, cache)}
