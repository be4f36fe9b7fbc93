"""Evidence: the index, and resolving ids and references to a page revision with a text snippet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.dom import with_dom
from rosterlink.functions.ids import bound, evidence_id
from rosterlink.functions.text import clean_snippet, registry_url, revision_url, truncate, underscored
from rosterlink.operators.members import SNIPPET_REF
from rosterlink.sources.page_store import ORDER, PageStore, pages_of, whole_pages
from rosterlink.sources.readers import latest
from rosterlink.sources.written import materialise

#: Fixed value: where the registry's documents are served.
REGISTRY_URL = "https://search.dip.bundestag.de/api/v1"


def upsert_index(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """The index with ``updates`` (in order of ``batch_pos`` if they have it); an entry of the same id is replaced, row references never stay."""
    order = F.col("batch_pos") if "batch_pos" in updates.columns else F.lit(1)
    cols = [c for c in existing.columns if c not in ("snippet_ref", "_order")]
    rows = existing.select(*cols, F.lit(-1).cast("bigint").alias("_order")).unionByName(updates.select(*cols, order.cast("bigint").alias("_order")))
    return latest(rows, ["evidence_id"], ["_order"]).drop("_order")


def rebuild_index(raw_pages: DataFrame) -> DataFrame:
    """Index entries of all stored pages in one job: the stored hash, else that of the whole response (``raw_sha256``), and
    where the response and its metadata lie, if pages say so; of equal responses the first place counts."""
    rows = raw_pages
    if "raw_sha256" in rows.columns:
        rows = rows.withColumn("sha256", F.coalesce("sha256", "raw_sha256"))
    rows = rows.withColumn("page_title", underscored(F.col("page_title")))
    places = {"metadata_path": "cache_metadata_path", "raw_path": "cache_raw_path"}
    entry = F.struct(
        F.lit("mediawiki").alias("source_kind"), "page_title", "page_id", "revision_id", "sha256", F.lit("parse").alias("endpoint"),
        *(F.col(c).alias(name) for c, name in places.items() if c in rows.columns),
    )
    ids = evidence_id(F.col("page_id"), F.col("revision_id"), F.lit("parse"), F.col("sha256"))
    return rows.groupBy(ids.alias("evidence_id")).agg(F.min(entry).alias("e")).select("evidence_id", "e.*")


def lead_paragraph(dom: Column, size: int = 500) -> Column:
    """The first paragraph of at least 80 characters, else the first that is not empty; truncated."""
    first = lambda texts, least: F.get(F.filter(texts, lambda t: F.length(t) >= least), F.lit(0))
    return truncate(bound(F.transform(dom["paragraphs"], lambda p: clean_snippet(p["text"])), lambda texts: F.coalesce(first(texts, 80), first(texts, 1))), size)


def _citable_rows(dom: Column, size: int) -> Column:
    wiki = F.filter(dom["tables"], lambda t: t["is_wikitable"])
    tables = F.when(F.size(wiki) > 0, wiki).otherwise(dom["tables"])

    def row(cells: Column, t: Column, r: Column) -> Column:
        joined = F.array_join(F.filter(F.transform(cells, lambda c: clean_snippet(c["text"])), lambda x: x != ""), " | ")
        return F.struct(t.alias("table_index"), r.alias("row_index"), truncate(bound(joined, lambda x: F.when(x != "", clean_snippet(x))), size).alias("row_text"))

    def rows(table: Column, t: Column) -> Column:
        body = F.when(F.size(table["rows"]) > 1, F.slice(table["rows"], F.lit(2), F.greatest(F.size(table["rows"]) - 1, F.lit(0)))).otherwise(table["rows"])
        return F.transform(body, lambda cells, r: row(cells, t, r))

    return F.flatten(F.transform(tables, rows))


def page_snippets(doms: DataFrame, key: str = "evidence_id", size: int = 500) -> DataFrame:
    """``(key, table_index, row_index, row_text)``: data rows of every citable table (a table's only row is its row 0),
    and each page's lead paragraph as row -1 of table -1, from one pass over the pages."""
    lead = F.struct(F.lit(-1).alias("table_index"), F.lit(-1).alias("row_index"), lead_paragraph(F.col("dom"), size).alias("row_text"))
    every = F.concat(_citable_rows(F.col("dom"), size), F.array(lead))
    return doms.select(key, F.explode(every).alias("r")).select(key, "r.*")


def legacy_ref(text: Column) -> Column:
    """``table_row:t:r`` as ``struct(table_index, row_index)``, a missing row is 0; null for anything else."""
    parts = F.split(text, ":")
    t = F.get(parts, F.lit(1)).try_cast("int")
    r = F.when(F.size(parts) > 2, F.get(parts, F.lit(2)).try_cast("int")).otherwise(0)
    return F.when((F.get(parts, F.lit(0)) == "table_row") & t.isNotNull() & r.isNotNull(), F.struct(t.alias("table_index"), r.alias("row_index")))


def _json(value: Column) -> Column:
    """A scalar as JSON."""
    text = F.to_json(F.struct(value.alias("v")))
    return F.substring(text, F.lit(6), F.length(text) - 6)


def _ref_text(ref: Column) -> Column:
    """A structured reference as indented JSON, without what is missing."""
    def body(part: Column, names: list[str], indent: str, more: Column | None = None) -> Column:
        fields = [F.when(part[n].isNotNull(), F.concat(F.lit(f'{indent}"{n}": '), _json(part[n]))) for n in names]
        return F.array_join(F.array_compact(F.array(*fields, *([more] if more is not None else []))), ",\n")

    match = F.concat(F.lit('    "match": {\n'), body(ref["match"], ["person_title", "name_cell"], " " * 8), F.lit("\n    }"))
    text = body(ref, ["version", "type", "table_index", "row_index", "row_kind", "title_hint"], " " * 4, F.when(ref["match"].isNotNull(), match))
    return F.when(ref.isNotNull(), F.concat(F.lit("{\n"), text, F.lit("\n}")))


#: What a reference is: there is none, it names a table row, or it is one that nothing can be found by.
NONE, PLACE, UNREADABLE = 0, 1, 2


def _struct_ref(kind: Column, table: Column, row: Column) -> Column:
    """A structured reference that says no more than its type and place."""
    none = F.lit(None)
    fields = {"version": none, "type": kind, "table_index": table, "row_index": row, "row_kind": none, "title_hint": none, "match": none}
    return F.struct(*(v.alias(k) for k, v in fields.items())).cast(SNIPPET_REF)


def text_ref(text: Column) -> Column:
    """``struct(state, structured, ref)`` of an older textual reference; one that can't be read keeps its text as ``type``."""
    at = legacy_ref(text)
    state = F.when(F.coalesce(text, F.lit("")) == "", NONE).when(at.isNotNull(), PLACE).otherwise(UNREADABLE)
    ref = F.when(state == PLACE, _struct_ref(F.lit("table_row"), at["table_index"], at["row_index"])).when(state == UNREADABLE, _struct_ref(text, F.lit(None), F.lit(None)))
    return F.struct(state.alias("state"), F.lit(False).alias("structured"), ref.alias("ref"))


def structured_ref(ref: Column) -> Column:
    """The same of a structured reference: one without any value is none, one of another type than ``table_row`` unreadable."""
    ref = ref.cast(SNIPPET_REF)
    state = F.when(ref.isNull() | (F.to_json(ref) == "{}"), NONE).when(ref["type"] == "table_row", PLACE).otherwise(UNREADABLE)
    return F.struct(state.alias("state"), F.lit(True).alias("structured"), F.when(state != NONE, ref).alias("ref"))


def _placed(refs: DataFrame) -> DataFrame:
    """``(evidence_id, purpose, given)`` of references in any of their forms."""
    purpose = F.col("purpose") if "purpose" in refs.columns else F.lit(None).cast("string")
    if "snippet_ref" not in refs.columns:
        there = F.col("table_index").isNotNull()
        ref = F.when(there, _struct_ref(F.lit("table_row"), F.col("table_index"), F.col("row_index")))
        given = F.struct(F.when(there, PLACE).otherwise(NONE).alias("state"), F.lit(True).alias("structured"), ref.alias("ref"))
    elif refs.schema["snippet_ref"].dataType.typeName() == "string":
        given = text_ref(F.col("snippet_ref"))
    else:
        given = structured_ref(F.col("snippet_ref"))
    return refs.select("evidence_id", purpose.alias("purpose"), given.alias("given"))


def _lists(params: Column) -> Column:
    """Request parameters ``map<string,string>``, lists as JSON, as ``map<string,array<string>>``."""
    one = lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).otherwise(F.array(F.coalesce(v, F.lit("None"))))
    return F.transform_values(params, lambda _, v: one(v))


def _stored_responses(e: DataFrame, pages: DataFrame | PageStore) -> DataFrame:
    """Index entries ``e`` joined with what is stored of their response, but for the HTML; ``page`` numbers the response.

    Entries name their response by path where both sides have one, else by title and revision. Of several stored copies the
    last fetched counts. Only keys and metadata are read and moved.
    """
    titled = e.where("page_title is not null").select("page_title")
    by_path = e.schema["at"].dataType.typeName() != "void" and "metadata_path" in pages_of(pages).columns
    table = pages_of(pages) if by_path else pages_of(pages, titled)
    has = lambda c, kind: F.col(c) if c in table.columns else F.lit(None).cast(kind)
    order = [c for c in ORDER if c in table.columns]
    meta = F.struct(
        F.col("page_title").alias("title"), has("page_id", "bigint").alias("page_id"), F.col("revision_id").alias("revision_id"), has("sha256", "string").alias("sha256"), F.col("retrieved_at").alias("retrieved_at"), F.col("url").alias("url"),
        has("endpoint", "string").alias("endpoint"), has("request_params", "map<string,string>").alias("params"), has("metadata_path", "string").alias("metadata_path"), has("raw_path", "string").alias("raw_path"),
    )
    title = underscored(F.col("page_title"))
    key = {"k_at": F.col("metadata_path")} if by_path else {"k_title": title, "k_revision": F.col("revision_id")}
    mine = [F.col("at")] if by_path else [F.col("page_title"), F.col("revision_id")]
    wanted = e.select(*(c.alias(k) for k, c in zip(key, mine))).distinct()
    met = table.select(title.alias("page_title"), *(c.alias(k) for k, c in key.items()), F.struct(*order).alias("order"), meta.alias("m")).join(wanted, list(key), "left_semi")
    best = met.groupBy(*key).agg(F.max_by(F.struct("page_title", "order", "m"), "order").alias("b"))
    # equal copies are counted over the whole page, as the HTML is fetched by its title and order
    copies = met.groupBy("page_title", "order").agg(F.count("*").alias("copies"))
    best = materialise(best.select(*key, "b.*").join(copies, ["page_title", "order"]).withColumn("page", F.xxhash64("page_title", "order")))
    return e.join(best.select(*(F.col(k).alias(f"_{k}") for k in key), "m", "page", F.col("page_title").alias("s_title"), "order", "copies"), _all_equal([(F.col(f"_{k}"), c) for k, c in zip(key, mine)]))


def _all_equal(pairs: list[tuple[Column, Column]]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & (a == b)
    return out


def resolve_evidence_refs(refs: DataFrame, index: DataFrame, pages: DataFrame | PageStore, prefer: str | tuple[str, ...] = "table_row", size: int = 500, registry: str = REGISTRY_URL) -> DataFrame:
    """References to revisions and snippets.

    A reference is ``(evidence_id, table_index, row_index, purpose)`` (null places: none), or ``(evidence_id, snippet_ref,
    purpose)`` with a structured or an older textual reference; an index entry's own older ``snippet_ref`` serves where
    the reference has none. ``pages`` are stored responses with their metadata, or a store of them; entries name theirs by
    ``cache_metadata_path`` (pages: ``metadata_path``) where both have it, else by title and revision, and of several
    stored copies the last fetched counts. Ids without an entry, and entries without a stored response, are dropped. The
    entry's fields count first, the metadata's where it lacks them. The URL is that of the page revision, of the registry's
    request, or the stored one, by source.

    ``prefer`` says when the page's lead paragraph serves. ``table_row``: only where there is no reference at all; one that
    can't be read, or whose row is not there, gives no snippet. ``lead_paragraph``: wherever no row is found.
    ``by_reference``: wherever no row is found, unless the reference is a structured one to a table row. Of several, each gives
    its rows, with its name in a column ``prefer``; pages are read and parsed once for all of them.

    Responses are chosen on keys; then only wanted pages are read whole, and each is parsed once, whatever the number of
    its references. HTML is never shuffled; rows and leads are joined back by key.
    """
    has = lambda df, c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind)
    refs = materialise(_placed(refs))
    e = index.join(refs.select("evidence_id").distinct(), "evidence_id", "left_semi")
    at = F.col("cache_metadata_path") if "cache_metadata_path" in index.columns else F.lit(None)
    e = materialise(e.select(
        "evidence_id", "source_kind", has(e, "page_title", "string").alias("page_title"), has(e, "page_id", "bigint").alias("page_id"), has(e, "revision_id", "bigint").alias("revision_id"), has(e, "sha256", "string").alias("sha256"),
        has(e, "endpoint", "string").alias("endpoint"), has(e, "params", "map<string,string>").alias("params"), at.cast("string").alias("at"), has(e, "cache_raw_path", "string").alias("raw_at"), text_ref(has(e, "snippet_ref", "string")).alias("own"),
    ))
    if "cache_metadata_path" not in index.columns:
        e = e.withColumn("at", F.lit(None))
    first = lambda a, b, empty: F.coalesce(F.nullif(F.col(a), F.lit(empty)), F.col(b))
    found = materialise(_stored_responses(e, pages).select(
        "evidence_id", "source_kind", first("page_title", "m.title", "").alias("page_title"), first("page_id", "m.page_id", 0).alias("page_id"), first("revision_id", "m.revision_id", 0).alias("revision_id"),
        first("sha256", "m.sha256", "").alias("sha256"), first("endpoint", "m.endpoint", "").alias("endpoint"), F.when(F.size("params") > 0, F.col("params")).otherwise(F.col("m.params")).alias("params"),
        F.col("m.retrieved_at").alias("retrieved_at_utc"), F.col("m.url").alias("source_url"), F.coalesce(F.col("at").cast("string"), "m.metadata_path").alias("cache_metadata_path"), F.coalesce("raw_at", "m.raw_path").alias("cache_raw_path"),
        "own", "page", "s_title", "order", "copies",
    ))
    wanted = found.where("source_kind = 'mediawiki'").select(F.col("s_title").alias("page_title"), "order", "copies", "page").distinct()
    snippets = materialise(page_snippets(with_dom(whole_pages(pages, wanted, ["html"]).where("html is not null").drop("page_title")), "page", size))
    # a reference without a place is one to the lead, row -1 of table -1: one join gives both
    found = found.drop("s_title", "order", "copies")
    keyed = refs.join(found, "evidence_id").withColumn("used", F.when(F.col("given.state") == NONE, F.col("own")).otherwise(F.col("given"))).drop("given", "own")
    placed = F.col("used.state") == PLACE
    place = {"_t": F.when(placed, F.coalesce("used.ref.table_index", F.lit(0))).otherwise(-1), "_r": F.when(placed, F.coalesce("used.ref.row_index", F.lit(0))).otherwise(-1)}
    snippets = snippets.select("page", F.col("table_index").alias("_t"), F.col("row_index").alias("_r"), "row_text")
    rows = keyed.withColumns(place).join(snippets, ["page", "_t", "_r"], "left")
    falls = {"table_row": F.col("used.state") == NONE, "lead_paragraph": F.lit(True), "by_reference": ~(placed & F.col("used.structured"))}
    lead = F.when(~placed, F.col("row_text"))
    prefers = [prefer] if isinstance(prefer, str) else list(prefer)
    if set(prefers) != {"table_row"}:
        rows = rows.join(snippets.where("_t = -1").select("page", F.col("row_text").alias("lead")), "page", "left")
        lead = F.col("lead")
    row = F.when(placed, F.col("row_text"))

    def chosen(p: str) -> Column:
        source = F.when(row.isNotNull(), "table_row").when(falls[p] & lead.isNotNull(), "lead_paragraph")
        return F.struct(F.lit(p).alias("prefer"), F.coalesce(row, F.when(falls[p], lead)).alias("snippet"), source.alias("snippet_source"))

    rows = rows.withColumn("_chosen", chosen(prefer) if isinstance(prefer, str) else F.explode(F.array(*map(chosen, prefers))))
    rows = rows.withColumns({c: F.col(f"_chosen.{c}") for c in ("prefer", "snippet", "snippet_source")})
    url = (
        F.when(F.col("source_kind") == "mediawiki", revision_url(F.coalesce("page_title", F.lit("")), F.col("revision_id")))
        .when(F.col("source_kind") == "dip", registry_url(F.lit(registry), F.coalesce("endpoint", F.lit("")), _lists(F.coalesce("params", F.create_map().cast("map<string,string>")))))
        .otherwise(F.coalesce("source_url", F.lit("")))
    )
    return rows.select(
        "evidence_id", "source_kind", "page_title", "page_id", "revision_id", "retrieved_at_utc", "sha256", "source_url", url.alias("canonical_url"), "cache_metadata_path", "cache_raw_path", "snippet", "snippet_source",
        F.when(placed, F.col("_t")).alias("table_index"), F.when(placed, F.col("_r")).alias("row_index"), "purpose", F.col("used.ref").alias("snippet_ref"), *([] if isinstance(prefer, str) else ["prefer"]),
    )


def resolve_evidence_ids(ids: DataFrame, index: DataFrame, pages: DataFrame | PageStore, size: int = 500, prefer: str = "lead_paragraph") -> DataFrame:
    """Distinct ids, each with its page's lead paragraph, or the row that its index entry's own reference names."""
    none = F.lit(None)
    refs = ids.select("evidence_id").distinct().select("evidence_id", none.cast("int").alias("table_index"), none.cast("int").alias("row_index"), none.cast("string").alias("purpose"))
    return resolve_evidence_refs(refs, index, pages, prefer, size)


def find_persons(docs: DataFrame, query: str, limit: int = 5) -> DataFrame:
    """Persons whose name or title has every word of the query, by name and id."""
    text = F.lower(F.concat_ws(" ", "name", F.replace("wikipedia_title", F.lit("_"), F.lit(" "))))
    for word in query.lower().split():
        docs = docs.where(text.contains(word))
    return docs.orderBy("name", "person_id").limit(limit)


def refs_of_documents(docs: DataFrame) -> DataFrame:
    """References ``(person_id, evidence_id, snippet_ref, purpose)`` of search documents: ``evidence_refs``, else the older map
    ``evidence_snippet_refs`` from id to reference where documents have one, else their bare ids, those only where no
    document has references."""
    one = docs.select("person_id", "evidence_refs", "evidence_ids", *(["evidence_snippet_refs"] if "evidence_snippet_refs" in docs.columns else []))
    refs = one.select("person_id", F.explode("evidence_refs").alias("r")).select("person_id", "r.evidence_id", F.col("r.snippet_ref").cast(SNIPPET_REF).alias("snippet_ref"), "r.purpose")
    has = F.coalesce(F.size("evidence_refs"), F.lit(0)) > 0
    if "evidence_snippet_refs" in docs.columns:
        older = one.where(~has).select("person_id", F.explode(F.map_entries("evidence_snippet_refs")).alias("e")).where("e.value is not null")
        fields = docs.schema["evidence_snippet_refs"].dataType.valueType.names
        known = lambda c: F.col(f"e.value.{c}") if c in fields else F.lit(None)
        names = ("version", "type", "table_index", "row_index", "row_kind", "title_hint", "match")
        refs = refs.unionByName(older.select("person_id", F.col("e.key").alias("evidence_id"), F.struct(*(known(c).alias(c) for c in names)).cast(SNIPPET_REF).alias("snippet_ref"), F.when(F.col("e.value.type") == "table_row", "membership_row").alias("purpose")))
        has = has | (F.coalesce(F.size("evidence_snippet_refs"), F.lit(0)) > 0)
    any_refs = F.broadcast(one.agg(F.coalesce(F.max(has), F.lit(False)).alias("any_refs")))  # one row
    bare = one.select("person_id", F.explode("evidence_ids").alias("evidence_id")).withColumn("k", F.lit(1)).join(any_refs.withColumn("k", F.lit(1)), "k").where("not any_refs")
    bare = bare.select("person_id", "evidence_id", F.lit(None).cast(SNIPPET_REF).alias("snippet_ref"), F.lit(None).cast("string").alias("purpose"))
    return refs.unionByName(bare)


def resolve_from_search(docs: DataFrame, query: str, index: DataFrame, pages: DataFrame | PageStore, limit: int = 5) -> DataFrame:
    """The evidence that the persons found cite, their list rows too."""
    return resolve_found(find_persons(docs, query, limit), index, pages)


def resolve_found(found: DataFrame, index: DataFrame, pages: DataFrame | PageStore) -> DataFrame:
    """The evidence that some search documents cite."""
    refs = materialise(refs_of_documents(materialise(found)).drop("person_id").distinct())
    return resolve_evidence_refs(refs, index, pages, "by_reference")


def _json_of(resolved: DataFrame) -> Column:
    return F.to_json(F.struct(*[c for c in resolved.columns if c not in ("table_index", "row_index")])).alias("json")


def as_json(resolved: DataFrame) -> DataFrame:
    """One JSON text a row, nulls left out; the reference is an object in it."""
    return resolved.select("evidence_id", _json_of(resolved))


def as_both(resolved: DataFrame) -> DataFrame:
    """``(evidence_id, markdown, json)``: both forms of each row in one pass."""
    return as_markdown(resolved.withColumn("json", _json_of(resolved)), "json")


def as_markdown(resolved: DataFrame, *keep: str) -> DataFrame:
    """A list entry for each row, beside the columns ``keep``; what is missing, or a revision of 0, has no line. Entries are parted by an empty line."""
    def line(label: str, c: str, text: Column | None = None) -> Column:
        return F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(f"  - **{label}**: "), F.col(c).cast("string") if text is None else text))

    quoted = lambda c, mark, end: F.concat(F.lit(mark), c, F.lit(end))
    rows = resolved.withColumns({"revision_id": F.nullif("revision_id", F.lit(0)), "ref_text": _ref_text(F.col("snippet_ref"))})
    return rows.select("evidence_id", F.concat_ws(
        "\n", F.concat(F.lit("- Evidence `"), "evidence_id", F.lit("`")), line("Source", "source_kind"), line("Page", "page_title"), line("Revision", "revision_id"), line("URL", "canonical_url"), line("Retrieved", "retrieved_at_utc"),
        line("SHA256", "sha256", quoted(F.substring("sha256", 1, 16), "`", "...`")), line("Snippet", "snippet", quoted(F.col("snippet"), '"', '"')), line("Snippet Source", "snippet_source"), line("Purpose", "purpose"),
        line("Snippet Ref", "ref_text", quoted(F.col("ref_text"), "```json\n", "\n```")),
    ).alias("markdown"), *keep)
