"""Member-list pages: choose the table, map its header, and turn rows into persons and mandates with row-level citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.dom import with_dom
from rosterlink.functions.ids import evidence_id, legislature_id, mandate_id, person_id, strip
from rosterlink.functions.text import BASE_URL, normalize_header, parse_date, underscored
from rosterlink.sources.page_store import PageStore, latest_of, pages_of
from rosterlink.sources.readers import page_sha256
from rosterlink.sources.written import materialise

#: Words of a heading above a members table; events that notes can name.
HEADING_WORDS = ["mitglieder", "abgeordnete", "fraktionen", "fraktion", "partei", "wahlkreis", "anmerkungen"]
EVENTS = ["nachgerückt", "ausgeschieden", "fraktionsaustritt", "parteiwechsel", "fraktionswechsel"]
#: Column roles by words of the header text, in order of precedence.
ROLES = [("name", ["name", "abgeordnete"]), ("party", ["partei", "fraktion"]), ("wahlkreis", ["wahlkreis"]), ("notes", ["anmerkung", "bemerkung", "notiz"]), ("start", ["von", "start", "beginn"]), ("end", ["bis", "ende"])]
SNIPPET_REF = "struct<version:int,type:string,table_index:int,row_index:int,row_kind:string,title_hint:string,match:struct<person_title:string,name_cell:string>>"
EVIDENCE_REF = f"struct<evidence_id:string,snippet_ref:{SNIPPET_REF},purpose:string,confidence:double,created_at:string>"


def _any(texts: Column, *words: str) -> Column:
    return F.exists(texts, lambda t: F.greatest(*(t.contains(w) for w in words), F.lit(False)))


def is_members_header(texts: Column) -> Column:
    return _any(texts, "name") & (_any(texts, "partei", "fraktion") | _any(texts, "wahlkreis"))


def choose_table(dom: Column, section_keywords: Column) -> Column:
    """The first table with a members header, else the first table after a heading that has one of the words."""
    by_header = F.get(F.filter(dom["tables"], lambda t: is_members_header(t["header"])), F.lit(0))
    words = F.concat(F.array(*map(F.lit, HEADING_WORDS)), F.coalesce(section_keywords, F.array().cast("array<string>")))
    named = F.filter(dom["heading_tables"], lambda h: F.exists(words, lambda w: normalize_header(h["heading_text"]).contains(w)))
    return F.coalesce(by_header, F.get(dom["tables"], F.get(named, F.lit(0))["table_pos"]))


def header_roles(texts: Column) -> Column:
    """``struct`` of the column index of every role (null: none); of several columns of one role the last counts."""
    def role(t: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, words in reversed(ROLES):
            out = F.when(F.greatest(*(t.contains(w) for w in words), F.lit(False)), name).otherwise(out)
        return out

    def last(at: Column, name: str) -> Column:
        return F.array_max(F.transform(F.filter(at, lambda x: x["r"] == name), lambda x: x["i"])).alias(name)

    roles = F.transform(texts, lambda t, i: F.struct(role(t).alias("r"), i.alias("i")))
    return F.get(F.transform(F.array(roles), lambda at: F.struct(*(last(at, name) for name, _ in ROLES))), F.lit(0))


def events_from_notes(notes: Column, evidence: Column) -> Column:
    """One event for each word that the notes have, in the order of ``EVENTS``; the description is the whole note."""
    one = lambda e: F.when(F.lower(notes).contains(e), F.struct(F.lit(e).alias("event_type"), strip(notes).alias("description"), F.array(evidence).alias("evidence_ids"), F.lit(None).cast("string").alias("date")))
    return F.array_compact(F.array(*map(one, EVENTS)))


def page_columns(pages: DataFrame | PageStore) -> list[str]:
    """What the parsers read of a page, but for its title."""
    have = pages_of(pages).columns
    return [c for c in ("page_id", "revision_id", "sha256", "parse_sha256", "html") if c in have]


def member_pages(pages: DataFrame | PageStore, seeds: DataFrame) -> DataFrame:
    """Seeds with the chosen table of their page, the last fetched of its title; ``error`` where there is none.

    Each page that a seed names is read whole and parsed once, whatever the number of its seeds; the result is written, so
    every job that starts from it reads narrow rows. Ids hold the page's stored hash, else that of its ``parse`` object.
    """
    s = seeds.select("seed_pos", F.col("key").alias("seed_key"), underscored(F.col("page_title")).alias("page_title"), "expected_start", "expected_end", "parliament", "state", "legislature_number", "section_keywords")
    doms = with_dom(latest_of(pages, s, page_columns(pages)))
    ids = doms.select("page_title", "page_id", "revision_id", page_sha256(doms).alias("sha256"), "dom")
    ids = ids.withColumn("evidence_id", evidence_id(F.col("page_id"), F.col("revision_id"), F.lit("parse"), F.col("sha256")))
    chosen = F.transform(F.array(choose_table(F.col("dom"), F.col("section_keywords"))), lambda t: F.struct(t.alias("table"), header_roles(t["header"]).alias("roles")))
    # pages are few bytes and much work: they keep their partitions, by the hint, and what is written is read in as many parts;
    # parsed pages go from the parser to that one shuffle and are not written before it
    ids = ids.repartition(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page_title")
    rows = materialise(ids.join(s.hint("shuffle_hash"), "page_title").withColumn("chosen", F.get(chosen, F.lit(0))).select("*", "chosen.table", "chosen.roles").drop("dom", "chosen"))
    found = F.greatest(*(F.col(f"roles.{r}").isNotNull() for r, _ in ROLES))
    return rows.withColumn("error", F.when(F.col("table").isNull(), "No members table found").when(~found, "No headers found"))


def parse_errors(parsed: DataFrame) -> DataFrame:
    return parsed.where("error is not null").select("seed_key", "page_title", "error")


def parse_member_lists(parsed: DataFrame, run_ts: str = "") -> DataFrame:
    """One row a member from ``member_pages``: person, mandate and the row-level reference; written once.

    Rows that are too short, or without a linked name, give nothing but count in ``row_index``.
    """
    rows = parsed.where("error is null").withColumn("table_index", F.col("table.index"))
    body = F.slice("table.rows", F.lit(2), F.greatest(F.size("table.rows") - 1, F.lit(0)))
    rows = rows.select("seed_pos", "seed_key", "page_title", "expected_start", "expected_end", "parliament", "state", "legislature_number", "evidence_id", "roles", "table_index", F.posexplode(body).alias("row_index", "cells"))
    widest = F.greatest(*(F.coalesce(F.col(f"roles.{r}"), F.lit(0)) for r, _ in ROLES))
    cell = lambda r: strip(F.get("cells", F.col(f"roles.{r}"))["text"])
    name = F.get("cells", F.col("roles.name"))
    rows = rows.where((F.size("cells") > widest) & F.col("roles.name").isNotNull() & name["has_link"])
    # the cells of a row as plain columns; written, as what follows uses each of them many times
    rows = materialise(rows.select(
        "seed_pos", "seed_key", "page_title", "parliament", "state", "legislature_number", "evidence_id", "table_index", "row_index",
        underscored(F.coalesce(F.nullif(name["link_title"], F.lit("")), strip(name["text"]))).alias("wikipedia_title"),
        F.coalesce(F.nullif(strip(name["link_text"]), F.lit("")), strip(name["text"])).alias("name"),
        cell("party").alias("party_name"), cell("wahlkreis").alias("wahlkreis"), cell("notes").alias("notes"),
        cell("start").alias("from"), cell("end").alias("to"), "expected_start", "expected_end",
    )).where("name <> ''")
    start = F.coalesce(parse_date(F.col("from")), parse_date(F.col("expected_start")), F.col("expected_start"))
    end = F.coalesce(parse_date(F.col("to")), parse_date(F.col("expected_end")), F.col("expected_end"))
    known = (F.length("parliament") > 0) & (F.length("state") > 0) & (F.col("legislature_number") != 0)
    rows = rows.withColumns({
        "person_id": person_id(F.col("wikipedia_title")), "wikipedia_url": F.concat(F.lit(BASE_URL), "wikipedia_title"),
        "legislature_id": F.when(known, legislature_id(F.col("parliament"), F.col("state"), F.col("legislature_number"))),
        "start_date": start, "end_date": end, "role": F.lit("member"),
    })
    rows = rows.drop("from", "to", "expected_start", "expected_end")
    ref = F.struct(
        F.lit(1).alias("version"), F.lit("table_row").alias("type"), F.col("table_index"), F.col("row_index"), F.lit("data").alias("row_kind"), F.col("page_title").alias("title_hint"),
        F.struct(F.col("wikipedia_title").alias("person_title"), F.col("name").alias("name_cell")).alias("match"),
    )
    evidence = F.struct(F.col("evidence_id"), ref.alias("snippet_ref"), F.lit("membership_row").alias("purpose"), F.lit(None).cast("double").alias("confidence"), F.lit(run_ts).alias("created_at"))
    return rows.withColumns({
        "mandate_id": mandate_id(F.col("person_id"), F.col("legislature_id"), F.col("start_date"), F.col("end_date"), F.col("role")),
        "events": F.coalesce(events_from_notes(F.col("notes"), F.col("evidence_id")), F.array().cast("array<struct<event_type:string,description:string,evidence_ids:array<string>,date:string>>")),
        "evidence_refs": F.array(evidence), "evidence_ids": F.array("evidence_id"),
    })


def validate_member_list(dom: Column) -> Column:
    """``struct(valid, reason)``: some table has a members header and a data row."""
    ok = F.exists(dom["tables"], lambda t: is_members_header(t["header"]) & (F.size(t["rows"]) > 1))
    reason = F.when(F.size(dom["tables"]) == 0, "No tables found").when(~ok, "No valid member list table found (need name and party or wahlkreis, and rows)")
    return F.struct(ok.alias("valid"), reason.alias("reason"))


def members_per_seed(members: DataFrame) -> DataFrame:
    return members.groupBy("seed_key").agg(F.count("*").alias("members"))
