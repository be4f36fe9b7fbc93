"""Stored pages: by key, from files that can't be read, without a hash, in several copies."""

import glob
import hashlib
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from rosterlink.functions import ids
from rosterlink.operators import evidence, members
from rosterlink.plans import jobs
from rosterlink.sources import page_store, readers
from rosterlink.sources.page_store import PageStore, latest_keys, latest_of, whole_pages

PAGE = "page_title string, page_id long, revision_id long, html string, sha256 string, retrieved_at string, url string"
INDEX = "evidence_id string, source_kind string, page_title string, page_id long, revision_id long, sha256 string"


def html(k):
    return f'<div class="mw-parser-output"><table class="wikitable"><tr><th>Name</th><th>Partei</th></tr><tr><td><a title="P {k}">P {k}</a></td><td>X{k}</td></tr></table><p>Absatz {k}</p></div>'


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(f"Seite {k}", k, 10 * k + r, html(f"{k}-{r}"), f"s{k}-{r}", f"2024-0{r + 1}", "u") for k in range(300) for r in range(2)]
    return spark.createDataFrame(rows, PAGE)


@pytest.fixture(scope="module")
def stored(pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    PageStore.write(pages, path, 64)
    return PageStore.open(pages.sparkSession, path)


def refs_to(spark, titles):
    one = [(f"e{k}", (1, "table_row", 0, 0, "data", None, None), "membership_row") for k in titles]
    return spark.createDataFrame(one, f"evidence_id string, snippet_ref {members.SNIPPET_REF}, purpose string")


def index_of(spark, titles):
    return spark.createDataFrame([(f"e{k}", "mediawiki", f"Seite_{k}", k, 10 * k + 1, None) for k in titles], INDEX)


def test_a_store_reads_only_the_folders_of_wanted_titles(spark, stored, tmp_path):
    """All other files of the store are broken: twenty references are still resolved."""
    want = range(0, 300, 15)
    kept = {r[0] for r in spark.createDataFrame([(f"Seite {k}",) for k in want], "t string").select(page_store.bucket_of(F.col("t"), 64)).collect()}
    broken = pathlib.Path(tmp_path / "store")
    for f in glob.glob(f"{stored.path}/*/*/*.parquet") + glob.glob(f"{stored.path}/about/*.json"):
        to = broken / pathlib.Path(f).relative_to(stored.path)
        to.parent.mkdir(parents=True, exist_ok=True)
        keep = "/about/" in f or int(f.split("bucket=")[1].split("/")[0]) in kept
        to.write_bytes(pathlib.Path(f).read_bytes() if keep else b"broken")
    assert len(kept) < 25
    store = PageStore.open(spark, str(broken))
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    out = evidence.resolve_evidence_refs(refs_to(spark, want), index_of(spark, range(300)), store)
    assert {r.evidence_id: r.snippet for r in out.collect()} == {f"e{k}": f"P {k}-1 | X{k}-1" for k in want}


def exchanges(df):
    """What the plan's shuffles move, as lines of its tree that stand below an exchange up to the next join."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("block", [1000, 7])
def test_pages_are_fetched_without_a_shuffle(spark, pages, stored, block):
    keys = latest_keys(pages)
    for source in (pages, stored):
        out = whole_pages(source, keys, ["html", "revision_id"], block)
        assert not exchanges(out)
        assert {r.page_title: (r.html, r.revision_id) for r in out.collect()} == {f"Seite_{k}": (html(f"{k}-1"), 10 * k + 1) for k in range(300)}


def test_the_same_rows_from_a_table_and_a_store(spark, pages, stored):
    titles = spark.createDataFrame([("Seite 7",), ("Seite_8",), ("Fehlt",), ("Seite 7",)], "page_title string")
    got = [sorted(map(tuple, latest_of(s, titles, ["page_id", "html"]).collect())) for s in (pages, stored)]
    assert got[0] == got[1] == [("Seite_7", 7, html("7-1")), ("Seite_8", 8, html("8-1"))]


def test_of_several_copies_the_last_counts(spark):
    """One revision fetched three times, the last twice: always the same hash, time and snippet."""
    rows = [("A", 1, 2, html(k), f"s{k}", f"2024-0{k}", f"u{k}") for k in (1, 3, 2)] + [("A", 1, 2, html(3), "s3", "2024-03", "u3"), ("A", 1, 1, html(9), "s9", "2025-01", "u9")]
    refs = spark.createDataFrame([("e", None, None, "x"), ("e", 0, 0, "y")], "evidence_id string, table_index int, row_index int, purpose string")
    index = spark.createDataFrame([("e", "mediawiki", "A", 1, 2, None)], INDEX)
    for order in (rows, rows[::-1]):
        got = sorted((r.purpose, r.sha256, r.retrieved_at_utc, r.source_url, r.snippet) for r in evidence.resolve_evidence_refs(refs, index, spark.createDataFrame(order, PAGE).repartition(3)).collect())
        assert got == [("x", "s3", "2024-03", "u3", "Absatz 3"), ("y", "s3", "2024-03", "u3", "P 3 | X3")]


def test_what_a_reference_is(spark):
    """Each form of a reference under each preference: none, a place, one that is not there, one that can't be read."""
    index = spark.createDataFrame([("e", "mediawiki", "A", 1, 2, None)], INDEX)
    stored = spark.createDataFrame([("A", 1, 2, html(1), "s", "t", "u")], PAGE)
    row, lead = ("P 1 | X1", "table_row"), ("Absatz 1", "lead_paragraph")
    text = {None: (lead, lead, lead), "": (lead, lead, lead), "table_row:0:0": (row, row, row), "table_row:0": (row, row, row), "table_row:0:5": ((None, None), lead, lead), "garbage": ((None, None), lead, lead), "table_row:x": ((None, None), lead, lead)}
    struct = {None: (lead, lead, lead), (1, "table_row", 0, 0): (row, row, row), (1, "table_row", None, None): (row, row, row), (1, "table_row", 3, 0): ((None, None), lead, (None, None)), (1, "section", 0, 0): ((None, None), lead, lead), (None, None, None, None): (lead, lead, lead)}
    cases = [(text, lambda v: v, "string"), (struct, lambda v: v and (*v, None, None, None), members.SNIPPET_REF)]
    for table, full, kind in cases:
        refs = spark.createDataFrame([("e", full(v), str(v)) for v in table], f"evidence_id string, snippet_ref {kind}, purpose string")
        for k, prefer in enumerate(("table_row", "lead_paragraph", "by_reference")):
            got = {r.purpose: (r.snippet, r.snippet_source) for r in evidence.resolve_evidence_refs(refs, index, stored, prefer).collect()}
            assert got == {str(v): want[k] for v, want in table.items()}, prefer
    own = index.withColumn("snippet_ref", F.lit("table_row:x"))
    none = spark.createDataFrame([("e", None)], "evidence_id string, snippet_ref string")
    assert evidence.resolve_evidence_refs(none, own, stored).first().snippet is None


def put(folder, raw, metadata=None):
    folder.mkdir(parents=True)
    (folder / "raw.json").write_text(raw if isinstance(raw, str) else json.dumps(raw, ensure_ascii=False))
    if metadata is not None:
        (folder / "metadata.json").write_text(metadata if isinstance(metadata, str) else json.dumps(metadata))


def response(title, page, revision, text):
    return {"parse": {"title": title, "pageid": page, "revid": revision, "text": {"*": text}}}


def sha(value):
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def test_files_that_cannot_be_read_and_pages_without_a_hash(spark, tmp_path):
    whole = {k: response(f"Liste Ü{k}", k, 10 * k, html(k)) for k in (1, 2, 3)}
    put(tmp_path / "a" / "1", whole[1], {"page_title": "Liste Ü1", "page_id": 1, "revision_id": 10, "sha256": "stored", "retrieved_at": "t"})
    put(tmp_path / "a" / "2", whole[2], {"page_title": "Liste Ü2", "page_id": 2, "revision_id": 20, "retrieved_at": "t"})
    put(tmp_path / "a" / "3", whole[3])
    put(tmp_path / "a" / "4", json.dumps(response("Liste 4", 4, 40, "x"))[:-9], {"page_title": "Liste 4"})
    put(tmp_path / "a" / "5", "[1, 2]", None)
    put(tmp_path / "a" / "6", response("Liste 6", 6, 60, html(6)), '{"page_title": ')
    pages = readers.read_raw_pages(spark, str(tmp_path / "a"))
    got = {r.page_title: r for r in pages.collect()}
    assert sorted(got) == ["Liste_6", "Liste_Ü1", "Liste_Ü2", "Liste_Ü3"]
    errors = readers.read_errors(spark, str(tmp_path / "a")).collect()
    assert sorted((r.path.split("/a/")[1], r.error) for r in errors) == [("4/raw.json", "No readable JSON"), ("5/raw.json", "No readable JSON"), ("6/metadata.json", "No readable JSON")]
    assert (got["Liste_Ü1"].parse_sha256, got["Liste_Ü1"].raw_sha256, got["Liste_Ü1"].sha256) == (None, None, "stored")
    assert [(got[f"Liste_Ü{k}"].sha256, got[f"Liste_Ü{k}"].parse_sha256, got[f"Liste_Ü{k}"].raw_sha256) for k in (2, 3)] == [(None, sha(whole[k]["parse"]), sha(whole[k])) for k in (2, 3)]
    seeds = spark.createDataFrame([(k, f"k{k}", f"Liste Ü{k}", "", "", "P", "S", k, []) for k in (1, 2, 3)], "seed_pos int, key string, page_title string, expected_start string, expected_end string, parliament string, state string, legislature_number int, section_keywords array<string>")
    rows = {r.page_title: r.evidence_id for r in members.parse_member_lists(members.member_pages(pages, seeds)).collect()}
    want = {k: "stored" if k == 1 else sha(whole[k]["parse"]) for k in (1, 2, 3)}
    expected = spark.createDataFrame([(k, 10 * k, want[k]) for k in want], "p long, r long, s string").select("p", ids.evidence_id(F.col("p"), F.col("r"), F.lit("parse"), F.col("s")).alias("id"))
    assert rows == {f"Liste_Ü{r.p}": r.id for r in expected.collect()}
    index = {r.page_title: r.sha256 for r in evidence.rebuild_index(pages).collect()}
    assert index == {"Liste_Ü1": "stored", "Liste_Ü2": sha(whole[2]), "Liste_Ü3": sha(whole[3]), "Liste_6": sha(response("Liste 6", 6, 60, html(6)))}


def test_the_last_line_of_an_id_wins_in_a_file_of_many_blocks(spark, tmp_path):
    lines = [json.dumps({"evidence_id": f"e{k % 40}", "source_kind": str(k), "endpoint": "x" * 50}) for k in range(2000)]
    (tmp_path / "index.jsonl").write_text("\n".join(lines) + "\n\n{broken\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", "7k", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.evidence_id: int(r.source_kind) for r in readers.read_evidence_index(spark, str(tmp_path / "index.jsonl")).collect()}
            assert got == {f"e{k}": 1960 + k for k in range(40)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_whole_job_from_a_store(spark, pages, stored):
    """The same tables from a table of pages and from a store of them."""
    seeds = spark.createDataFrame([(k, f"k{k}", f"Seite {k}", "2000-01-01", "", "P", "S", k, []) for k in (3, 4)], "seed_pos int, key string, page_title string, expected_start string, expected_end string, parliament string, state string, legislature_number int, section_keywords array<string>")
    dip = spark.createDataFrame([(7, "P", "3-1", None, None, "X", [17], [], 0)], "dip_person_id long, vorname string, nachname string, namenszusatz string, titel string, fraktion string, wahlperiode array<int>, person_roles array<map<string,string>>, dip_pos int")
    for name in ("persons", "mandates", "evidence", "edges"):
        a, b = ([sorted(map(repr, jobs.run_pipeline(s, seeds, dip, None, "now")[name].collect()))] for s in (pages, stored))
        assert a == b and a[0]
