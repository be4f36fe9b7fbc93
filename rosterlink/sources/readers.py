"""Stored responses as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlink.functions.text import page_url, response_sha256, underscored
from rosterlink.sources.page_store import latest_keys, whole_pages

PARSE = "parse struct<title:string,pageid:bigint,revid:bigint,displaytitle:string,text:struct<`*`:string>>"
QUERY = "query struct<pages:map<string,struct<pageid:bigint,title:string,revisions:array<struct<revid:bigint,timestamp:string>>>>>"
SEARCH = "query struct<search:array<struct<title:string,snippet:string>>>"
DIP_PERSON = "struct<id:bigint,vorname:string,nachname:string,namenszusatz:string,titel:string,fraktion:array<string>,wahlperiode:array<int>,person_roles:array<map<string,string>>>"
DIP_PAGE = f"numFound bigint, cursor string, documents array<{DIP_PERSON}>"
METADATA = "request_params map<string,string>, retrieved_at string, sha256 string, url string, page_title string, page_id bigint, revision_id bigint, endpoint_kind string"
INDEX = "evidence_id string, source_kind string, cache_metadata_path string, cache_raw_path string, page_title string, page_id bigint, revision_id bigint, sha256 string, endpoint string, params map<string,string>"


def parse_responses(raw: DataFrame) -> DataFrame:
    """Project parse responses (column ``parse``, other columns stay): missing ids are 0, missing texts empty."""
    p = F.col("parse")
    rest = [c for c in raw.columns if c != "parse"]
    return raw.select(*rest, underscored(F.coalesce(p["title"], F.lit(""))).alias("page_title"), F.coalesce(p["pageid"], F.lit(0)).alias("page_id"), F.coalesce(p["revid"], F.lit(0)).alias("revision_id"), F.coalesce(p["text"]["*"], F.lit("")).alias("html"))


def _json_files(spark: SparkSession, path: str, schema: str, name: str) -> DataFrame:
    """``(path, directory, value, json)`` of files of one JSON document each; ``json`` is null where a file holds none."""
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=name)
    at = F.col("_metadata.file_path")
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = text.select(at.alias("path"), F.regexp_replace(at, "/[^/]*$", "").alias("directory"), "value", parsed.alias("json"))
    return rows.withColumn("json", F.when(F.col("json._corrupt").isNull() & F.trim("value").startswith("{"), F.col("json").dropFields("_corrupt")))


def read_errors(spark: SparkSession, path: str, name: str = "*.json") -> DataFrame:
    """``(path, error)`` of the stored responses and metadata under ``path`` that can't be read. A file of no bytes counts as missing."""
    return _json_files(spark, path, "_any string", name).where("json is null").select("path", F.lit("No readable JSON").alias("error"))


def read_parse_responses(spark: SparkSession, path: str) -> DataFrame:
    """One response a file; ``directory`` says where it lies, for the join with its metadata, ``raw_json`` is its text.

    Files that can't be read give no page; ``read_errors`` has them.
    """
    raw = _json_files(spark, path, PARSE, "raw.json").where("json is not null")
    return parse_responses(raw.select("json.parse", "directory", F.col("path").alias("raw_path"), F.col("value").alias("raw_json")))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Response metadata; a missing url is made from the title. Files that can't be read count as missing."""
    raw = _json_files(spark, path, METADATA, "metadata.json").where("json is not null")
    return complete_metadata(raw.select("json.*", "directory", F.col("path").alias("metadata_path")))


def complete_metadata(meta: DataFrame) -> DataFrame:
    return meta.withColumn("url", F.coalesce(F.nullif("url", F.lit("")), page_url(F.col("page_title"), F.lit(None).cast("bigint"))))


def read_raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages from files: every parse response under ``path`` with the metadata of its directory.

    Values of the response come first, those of its metadata where the response lacks them; a response without metadata
    keeps its row with null provenance. ``parse_sha256`` and ``raw_sha256`` are worked out for responses whose metadata has
    no hash, and only for those: the hashes of their ``parse`` object, which ids of parsed pages then hold, and of the whole.
    Both sides are one file a row, and only the metadata's few columns are joined.
    """
    m = read_metadata(spark, path)
    m = m.select("directory", F.col("page_title").alias("m_title"), F.col("page_id").alias("m_page"), F.col("revision_id").alias("m_revision"), F.nullif("sha256", F.lit("")).alias("sha256"), "retrieved_at", "url", F.col("metadata_path"), "endpoint_kind", "request_params")
    rows = read_parse_responses(spark, path).join(m, "directory", "left")
    known = lambda c, other, empty: F.coalesce(F.nullif(c, F.lit(empty)), other, F.lit(empty))
    title = known("page_title", underscored(F.col("m_title")), "")
    rows = rows.withColumns({"page_title": title, "page_id": known("page_id", F.col("m_page"), 0), "revision_id": known("revision_id", F.col("m_revision"), 0)}).drop("m_title", "m_page", "m_revision")
    return with_own_hashes(rows)


def with_own_hashes(responses: DataFrame) -> DataFrame:
    """``raw_sha256`` and ``parse_sha256`` in the place of ``raw_json``, for responses without a stored hash; others have none."""
    own = responses.withColumn("own", response_sha256(F.when(F.col("sha256").isNull(), F.col("raw_json"))))
    return own.withColumns({"raw_sha256": F.col("own.raw"), "parse_sha256": F.col("own.parse")}).drop("own", "raw_json")


def page_sha256(pages: DataFrame) -> Column:
    """The hash that ids of parsed pages hold: the stored one, else that of the ``parse`` object where pages have it."""
    return F.coalesce("sha256", "parse_sha256") if "parse_sha256" in pages.columns else F.col("sha256")


def read_query_responses(spark: SparkSession, path: str, name: str = "*.json") -> DataFrame:
    """``page_revisions`` of stored query responses, one a file, with their ``directory``."""
    return page_revisions(_json_files(spark, path, QUERY, name).where("json is not null").select("json.query", "directory"))


def read_search_responses(spark: SparkSession, path: str, name: str = "*.json") -> DataFrame:
    """``search_hits`` of stored search responses, one a file, with their ``directory``."""
    return search_hits(_json_files(spark, path, SEARCH, name).where("json is not null").select("json.query", "directory"))


def page_revisions(responses: DataFrame) -> DataFrame:
    """First page and first revision of each query response (column ``query``); ``error`` where there is no page."""
    page = F.get(F.map_values("query.pages"), F.lit(0))
    revision = F.get(page["revisions"], F.lit(0))
    rest = [c for c in responses.columns if c != "query"]
    return responses.select(*rest, page["title"].alias("page_title"), page["pageid"].alias("page_id"), revision["revid"].alias("revision_id"), revision["timestamp"].alias("revision_timestamp"), F.when(page.isNull(), F.lit("No pages in response")).alias("error"))


def search_hits(responses: DataFrame) -> DataFrame:
    """Hits of search responses (column ``query``), in order."""
    rest = [c for c in responses.columns if c != "query"]
    return responses.select(*rest, F.posexplode("query.search").alias("result_pos", "hit")).select(*rest, "result_pos", "hit.title", "hit.snippet")


def dip_persons(pages: DataFrame) -> DataFrame:
    """Persons of registry list pages (columns ``wp``, ``page``, ``documents``), with their place ``dip_pos`` and first group."""
    rows = pages.select("wp", "page", F.posexplode("documents").alias("pos", "d"))
    place = F.struct("wp", "page", "pos").alias("dip_pos")
    return rows.select(place, F.col("d.id").alias("dip_person_id"), "d.vorname", "d.nachname", "d.namenszusatz", "d.titel", F.get("d.fraktion", F.lit(0)).alias("fraktion"), "d.wahlperiode", "d.person_roles")


def read_dip_pages(spark: SparkSession, path: str) -> DataFrame:
    """Registry pages ``(path, wp, page, numFound, cursor, documents)`` from files.

    ``fraktion`` may be a text or a list in the files and is a list here. Term and page are those of a directory named
    ``..._wp19_page2`` or, for other names, of ``metadata.json`` beside the page (the first ``f.wahlperiode`` of its
    request, and its ``page``); a page without either is page 1 of term 0.
    """
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    files = text.select("value", F.col("_metadata.file_path").alias("path"), F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("directory"))
    meta = files.where("path like '%/metadata.json'").select(
        "directory", F.get_json_object("value", r"$.page").try_cast("int").alias("m_page"),
        F.regexp_extract(F.get_json_object("value", "$.request_params"), r'"f\.wahlperiode"\s*:\s*\[?\s*"?(\d+)', 1).try_cast("int").alias("m_wp"),
    )
    listed = F.regexp_replace("value", r'"fraktion"\s*:\s*("(?:[^"\\]|\\.)*")', r'"fraktion": [$1]')
    rows = files.where("path not like '%/metadata.json'").select("path", "directory", F.from_json(listed, DIP_PAGE).alias("p")).join(meta, "directory", "left")
    named = lambda what: F.regexp_extract("path", rf"{what}(\d+)[^/]*/[^/]*$", 1).try_cast("int")
    return rows.select("path", F.coalesce(named("_wp"), "m_wp", F.lit(0)).alias("wp"), F.coalesce(named("_page"), "m_page", F.lit(1)).alias("page"), "p.*")


def per_wp(persons: DataFrame, first: int, last: int) -> DataFrame:
    """A row for each electoral term from ``first`` to ``last`` that a person sat in: the registry read term by term, repeats kept."""
    return persons.withColumn("wp", F.explode(F.filter("wahlperiode", lambda w: (w >= first) & (w <= last))))


def read_evidence_index(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; blank and corrupt lines are left out and the last line of an id wins, by file and place in the file."""
    raw = spark.read.schema(f"{INDEX}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    # a task reads a block of a file from its first line to its last, so lines stand in order of their block and this id
    placed = raw.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()})
    order = ["_file", "_block", "_line"]
    return latest(placed.where("_corrupt is null and evidence_id is not null"), ["evidence_id"], order).drop("_corrupt", *order)


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the order of ``order``."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_pages(raw_pages: DataFrame) -> DataFrame:
    """The last fetched response of each title: by time, then revision, then hash where pages have one.

    The order is found on keys alone and only the pages that win are read whole; they are never shuffled. Only where a
    winner is stored several times (equal in all of these) its copies meet in one more shuffle, and one stays.
    """
    return whole_pages(raw_pages, latest_keys(raw_pages), raw_pages.columns).select(*raw_pages.columns)


def pages_to_refresh(current: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Titles whose stored revision (``stored``: latest per title) is missing or not the current one."""
    have = stored.select("page_title", F.col("revision_id").alias("stored_revision_id"))
    out = current.select("page_title", "revision_id").join(have, "page_title", "left")
    return out if force else out.where("stored_revision_id is null or stored_revision_id <> revision_id")


SEED = "seed_pos int, key string, page_title string, expected_start string, expected_end string, parliament string, state string, legislature_number int, section_keywords array<string>, page_id bigint, revision_id bigint"
REGISTRY = "landtag_pos int, landtag_key string, key_prefix string, state string, parliament string, wikipedia_index_title string, member_list_search array<string>"
OVERRIDE = "wikipedia_title string, dip_person_id bigint, status string, reason string"


def expected_keywords(spark: SparkSession, path: str) -> DataFrame:
    """``(landtag_key, keyword)``: the table keywords that a parliament's lists are expected to have, its own or the file's defaults."""
    doc = _yaml(path)
    default = doc.get("defaults", {}).get("expected_table_keywords", [])
    rows = [(key, k) for key, r in doc.get("landtage", {}).items() for k in r.get("expected_table_keywords", default)]
    return spark.createDataFrame(rows, "landtag_key string, keyword string")


def load_seeds(spark: SparkSession, path: str) -> DataFrame:
    """The seeds of a YAML file, in its order."""
    rows = []
    for k, (key, s) in enumerate(_yaml(path).get("seeds", {}).items()):
        hints, span = s.get("hints", {}), s.get("expected_time_range", {})
        rows.append((k, s.get("key", key), s.get("page_title"), span.get("start"), span.get("end"), hints.get("parliament"), hints.get("state"), hints.get("legislature_number"), hints.get("section_keywords"), s.get("page_id"), s.get("revision_id")))
    return spark.createDataFrame(rows, SEED)


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    rows = [(k, key, r.get("key_prefix"), r.get("state"), r.get("parliament"), r.get("wikipedia_index_title"), r.get("member_list_search")) for k, (key, r) in enumerate(_yaml(path).get("landtage", {}).items())]
    return spark.createDataFrame(rows, REGISTRY)


def load_overrides(spark: SparkSession, path: str) -> DataFrame:
    rows = [(title, o.get("dip_person_id"), o.get("status", "accepted"), o.get("reason")) for title, o in _yaml(path).get("overrides", {}).items()]
    return spark.createDataFrame(rows, OVERRIDE)


def _yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
