import glob
import hashlib
import json
import os
import pathlib
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from rosterlink.functions import ids, text
from rosterlink.functions.dom import parse
from rosterlink.operators import evidence, linking, members, persons
from rosterlink.plans.jobs import run_from_files, run_pipeline
from rosterlink.sinks import graph
from rosterlink.sinks.export import export
from rosterlink.sources import readers, written

SEED = "seed_pos int, key string, page_title string, expected_start string, expected_end string, parliament string, state string, legislature_number int, section_keywords array<string>"
PAGE = "page_title string, page_id long, revision_id long, html string, sha256 string, retrieved_at string, url string"
LIST = '<div class="mw-parser-output"><table class="wikitable sortable"><tr><th>Name</th><th>Partei</th><th>Wahlkreis</th></tr><tr><td><a href="/wiki/T" title="Ada Beispiel">Ada Beispiel</a></td><td>Blaue Liste</td><td>Musterau[2]</td></tr><tr><td>Ohne Link</td><td>Grüne Mitte</td><td>X</td></tr><tr><td><a>Zweite</a></td><td>Grüne Mitte</td><td>Y</td></tr></table></div>'


def test_uuid5_is_the_standard_one(spark):
    names = ["Müller", "a_b", "", "日本"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(ids.uuid5(ids.PERSON, F.col("n"))).collect()
    assert [r[0] for r in got] == [str(uuid.uuid5(uuid.UUID(ids.PERSON), n)) for n in names]


def test_dom_nesting():
    d = parse("<div class='mw-parser-output'><p>a<p>b</p><table><tr><td>x<table><tr><td>y</table></td></tr></table><script>var t='</p>'</script></div>")
    assert [p["text"] for p in d["paragraphs"]][1] == "b"
    assert len(d["tables"]) == 2 and len(d["tables"][0]["rows"]) == 2
    assert parse(None)["tables"] == [] and parse("")["intro_parts"] == []
    deep = parse("<div class='mw-parser-output'>" + "<b>" * 5000 + "<table><tr><td>z</td></tr></table>")
    assert deep["tables"][0]["rows"][0][0]["text"] == "z"


def _seed(spark):
    return spark.createDataFrame([(0, "k", "Liste", "2001-05-01", "", "P", "S", 17, ["Mitglieder"])], SEED)


def test_member_list(spark):
    pages = spark.createDataFrame([("Liste", 1, 2, LIST, "s", "t", "u")], PAGE)
    rows = members.parse_member_lists(members.member_pages(pages, _seed(spark))).orderBy("row_index").collect()
    assert [(r.name, r.wikipedia_title, r.party_name, r.row_index, r.table_index, r.start_date) for r in rows] == [("Ada Beispiel", "Ada_Beispiel", "Blaue Liste", 0, 0, "2001-05-01"), ("Zweite", "Zweite", "Grüne Mitte", 2, 0, "2001-05-01")]
    again = members.parse_member_lists(members.member_pages(pages, _seed(spark))).orderBy("row_index").collect()
    assert rows == again and rows[0].evidence_refs[0].purpose == "membership_row"
    bad = spark.createDataFrame([("Liste", 1, 2, "<p>nothing", "s", "t", "u")], PAGE)
    parsed = members.member_pages(bad, _seed(spark))
    assert members.parse_errors(parsed).first().error == "No members table found" and members.parse_member_lists(parsed).count() == 0


def test_person_page(spark):
    html = '<div class="mw-parser-output"><p>Eins.</p><p>Zwei.</p><table class="infobox"><tr><th>Geboren</th><td><time datetime="1971-03-04">1</time></td></tr><tr><th>Gestorben</th><td><time datetime="2019-08-07">x</time></td></tr></table></div>'
    p = persons.parse_person_pages(spark.createDataFrame([("T", 1, 2, html, "s", "t", "u")], PAGE)).first()
    assert (p.birth_date, p.birth_date_status, p.death_date, p.intro) == ("1971-03-04", "extracted", "2019-08-07", "Eins.\n\nZwei.")


@pytest.mark.parametrize("given, want", [("2001-05-01", "2001-05-01"), ("1.5.2001", "2001-05-01"), ("1. März 2010", "2010-03-01"), ("1. Sept. 2010", "2010-09-01"), ("2001", None), ("kein", None), (None, None), ("31.2.2001", None)])
def test_dates(spark, given, want):
    assert spark.createDataFrame([(given,)], "t string").select(text.parse_date(F.col("t"))).first()[0] == want


def test_snippets(spark):
    t = "  Ein[1] Satz mit[23]\n Rest " + "wort " * 300
    r = spark.createDataFrame([(t,)], "t string").select(text.clean_snippet(F.col("t")).alias("c")).select("c", text.truncate(F.col("c"), 100).alias("k"), text.truncate(F.lit("x" * 200), 100).alias("h")).first()
    assert r.c.startswith("Ein Satz mit Rest wort") and r.k.endswith("...") and len(r.k) <= 103 and len(r.h) == 103


def test_canonical_json(spark):
    doc = {"b": [1, "ü"], "a": {"y": None, "x": 1.5}}
    want = hashlib.sha256(json.dumps(doc, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    got = spark.createDataFrame([(json.dumps(doc),), ("{bad",), (None,)], "j string").select(text.canonical_json_sha256("j")).collect()
    assert [r[0] for r in got] == [want, None, None]


WIKI = [("w1", "A", "Max Mustermann"), ("w2", "B", "Anna Maria Schmidt"), ("w3", "C", "Jörg Größe"), ("w4", "D", "Solo"), ("w5", "E", "Max von Ohne"), ("w6", "F", "Eva Doppelt"), ("w7", "G", "Über Steuert")]
DIP = [(1, "Max", "Mustermann", None), (2, "Anna", "Schmidt", "Maria"), (3, "Jörg", "Grösse", None), (4, "Max", "Anders", "von"), (5, "Eva", "Doppelt", None), (6, "Eva", "Doppelt", "Jr."), (7, None, "Steuert", None), (8, "Max", None, None)]


def _link_tables(spark):
    wiki = spark.createDataFrame([(i, t, n, 1, ["e"]) for i, t, n in WIKI], "id string, wikipedia_title string, name string, page_id long, evidence_ids array<string>")
    dip = spark.createDataFrame([(*d, k, ["d"]) for k, d in enumerate(DIP)], "dip_person_id long, vorname string, nachname string, namenszusatz string, dip_pos int, evidence_ids array<string>")
    return wiki, dip


def test_blocking_loses_no_pair(spark):
    wiki, dip = _link_tables(spark)
    every = linking.wiki_keys(wiki).join(linking.dip_keys(dip), F.lit(True)).withColumn("score", linking.score()).where("score >= 0.5")
    want = {tuple(r) for r in every.select("wiki_id", "dip_person_id", "score").collect()}
    got = [tuple(r) for r in linking.candidates(wiki, dip).select("wiki_id", "dip_person_id", "score").collect()]
    assert set(got) == want and len(got) == len(want) and ("w5", 4, 0.5) in want


def test_reconcile(spark):
    wiki, dip = _link_tables(spark)
    o = spark.createDataFrame([("G", 7, "accepted", "known"), ("D", 99, "accepted", None), ("A", 1, "rejected", None)], readers.OVERRIDE)
    a, c = linking.reconcile(wiki, dip, o)
    status = {(r.wikipedia_person_ref, r.dip_person_ref): (r.status, r.method, round(r.score, 2)) for r in a.collect()}
    assert status[("w2", "2")] == ("accepted", "ruleset", 1.0) and status[("w7", "7")] == ("accepted", "override", 1.0) and status[("w1", "1")][0] == "rejected"
    assert status[("w6", "5")][0] == status[("w6", "6")][0] == "pending" and not any(k[0] == "w4" for k in status)
    assert {r.display_name for r in c.collect()} == {"Anna Maria Schmidt", "Über Steuert"} | ({"Jörg Größe"} if status.get(("w3", "3"), ("",))[0] == "accepted" else set())
    assert linking.reconcile(wiki, dip)[0].where("wikipedia_person_ref = 'w4'").first().dip_person_ref == "none"


def test_index_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "x")], "evidence_id string, source_kind string")
    new = spark.createDataFrame([("b", "y", 1), ("b", "z", 2), ("c", "y", 0)], "evidence_id string, source_kind string, batch_pos int")
    once = evidence.upsert_index(old, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, evidence.upsert_index(once, new).collect())) == [("a", "x"), ("b", "z"), ("c", "y")]


def test_legacy_references(spark):
    r = spark.createDataFrame([("table_row:1:2",), ("table_row:x:2",), ("table_row:1:x",), ("table_row:3",), ("lead",), (None,)], "t string").select(evidence.legacy_ref(F.col("t")).alias("r")).collect()
    assert [tuple(x.r) if x.r else None for x in r] == [(1, 2), None, None, (3, 0), None, None]


def test_readers(spark, tmp_path):
    d = tmp_path / "cache" / "p1"
    d.mkdir(parents=True)
    (d / "raw.json").write_text(json.dumps({"parse": {"title": "Ada Beispiel", "pageid": 5, "text": {"*": "<p>x</p>"}}}))
    (d / "metadata.json").write_text(json.dumps({"page_title": "Ada Beispiel", "sha256": "s"}))
    r = readers.read_parse_responses(spark, str(tmp_path / "cache")).first()
    assert (r.page_title, r.page_id, r.revision_id, r.html) == ("Ada_Beispiel", 5, 0, "<p>x</p>")
    assert readers.read_metadata(spark, str(tmp_path / "cache")).first().url == "https://de.wikipedia.org/wiki/Ada%20Beispiel"
    (tmp_path / "i.jsonl").write_text('{"evidence_id": "a", "endpoint": "1"}\n\n{bad\n{"evidence_id": "a", "endpoint": "2"}\n')
    assert [(x.evidence_id, x.endpoint) for x in readers.read_evidence_index(spark, str(tmp_path / "i.jsonl")).collect()] == [("a", "2")]
    (tmp_path / "d1.json").write_text(json.dumps({"numFound": 2, "cursor": None, "documents": [{"id": 1, "fraktion": "X"}, {"id": 2, "fraktion": ["Y", "Z"]}]}))
    p = readers.read_dip_pages(spark, str(tmp_path / "d1.json"))
    assert [(x.dip_person_id, x.fraktion) for x in readers.dip_persons(p).orderBy("dip_pos").collect()] == [(1, "X"), (2, "Y")]
    _registry_files(tmp_path / "registry")
    got = readers.dip_persons(readers.read_dip_pages(spark, str(tmp_path / "registry"))).orderBy("dip_pos").collect()
    assert [(x.dip_pos.wp, x.dip_pos.page, x.nachname) for x in got] == [(4, 1, "Beispiel"), (4, 2, "Jemand"), (5, 3, "Niemand")]
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.json").write_text(json.dumps({"query": {"pages": {"9": {"pageid": 9, "title": "L", "revisions": [{"revid": 3, "timestamp": "t"}]}}}}))
    (tmp_path / "q" / "b.json").write_text(json.dumps({"query": {"pages": {}}}))
    assert sorted((x.page_id or 0, x.revision_id, x.error) for x in readers.read_query_responses(spark, str(tmp_path / "q")).collect()) == [(0, None, "No pages in response"), (9, 3, None)]
    (tmp_path / "h.json").write_text(json.dumps({"query": {"search": [{"title": "A", "snippet": "s"}, {"title": "B", "snippet": ""}]}}))
    assert [(x.result_pos, x.title) for x in readers.read_search_responses(spark, str(tmp_path), "h.json").orderBy("result_pos").collect()] == [(0, "A"), (1, "B")]
    (tmp_path / "r.yaml").write_text("defaults:\n  expected_table_keywords: [Name, Partei]\nlandtage:\n  xx: {key_prefix: xx_, state: X, parliament: P, wikipedia_index_title: T, member_list_search: [a]}\n  yy: {expected_table_keywords: [Liste]}\n")
    assert [r.landtag_key for r in readers.load_registry(spark, str(tmp_path / "r.yaml")).orderBy("landtag_pos").collect()] == ["xx", "yy"]
    assert {tuple(r) for r in readers.expected_keywords(spark, str(tmp_path / "r.yaml")).collect()} == {("xx", "Name"), ("xx", "Partei"), ("yy", "Liste")}
    (tmp_path / "s.yaml").write_text("seeds:\n  k1:\n    key: k1\n    page_title: Liste\n    expected_time_range: {start: '2001', end: '2005'}\n    hints: {parliament: P, state: S, legislature_number: 3}\n")
    assert readers.load_seeds(spark, str(tmp_path / "s.yaml")).first().legislature_number == 3


def _registry_files(root):
    for k, (name, last, meta) in enumerate([("list_wp4_page1", "Beispiel", {}), ("list_wp4_page2", "Jemand", {}), ("other", "Niemand", {"page": 3, "request_params": {"f.wahlperiode": [5], "limit": 100}})]):
        d = root / name
        d.mkdir(parents=True)
        (d / "raw.json").write_text(json.dumps({"numFound": 3, "cursor": None, "documents": [{"id": 10 + k, "vorname": "Ada", "nachname": last, "fraktion": ["X"], "wahlperiode": [4]}]}))
        (d / "metadata.json").write_text(json.dumps(meta))


def test_whole_job_from_files(spark, tmp_path):
    """From stored JSON files to graph tables."""
    pages = {"Liste": (1, 2, LIST), "Ada Beispiel": (3, 4, '<div class="mw-parser-output"><p>Ada Beispiel ist da.</p></div>')}
    for k, (title, (page, revision, html)) in enumerate(pages.items()):
        d = tmp_path / "cache" / str(k)
        d.mkdir(parents=True)
        (d / "raw.json").write_text(json.dumps({"parse": {"title": title, "pageid": page, "revid": revision if k else None, "text": {"*": html}}}))
        (d / "metadata.json").write_text(json.dumps({"page_title": title, "page_id": page, "revision_id": revision, "sha256": f"s{k}", "retrieved_at": "2024"}))
    _registry_files(tmp_path / "registry")
    (tmp_path / "seeds.yaml").write_text("seeds:\n  k:\n    key: k\n    page_title: Liste\n    expected_time_range: {start: '2001', end: '2005'}\n    hints: {parliament: P, state: S, legislature_number: 3}\n")
    (tmp_path / "o.yaml").write_text("overrides:\n  Zweite: {dip_person_id: 11, reason: known}\n")
    raw = {r.page_title: r for r in readers.read_raw_pages(spark, str(tmp_path / "cache")).collect()}
    assert (raw["Liste"].revision_id, raw["Liste"].sha256, raw["Ada_Beispiel"].revision_id, raw["Ada_Beispiel"].retrieved_at) == (2, "s0", 4, "2024")
    out = run_from_files(spark, str(tmp_path / "cache"), str(tmp_path / "registry"), str(tmp_path / "seeds.yaml"), str(tmp_path / "o.yaml"), "now", "run7")
    status = {(r.method, r.dip_person_ref): r.status for r in out["assertions"].collect()}
    assert status == {("ruleset", "10"): "accepted", ("override", "11"): "accepted"}
    labels = {r.label: r.n for r in graph.node_counts(out["nodes"]).collect()}
    assert labels == {"Person": 2, "Party": 2, "Legislature": 1, "Mandate": 2, "Evidence": 2, "WikipediaPersonRecord": 2, "DipPersonRecord": 3, "CanonicalPerson": 2, "PersonLinkAssertion": 2}
    cited = {r.name: sorted(x.purpose for x in r.evidence_refs) for r in out["persons"].collect()}
    assert cited == {"Ada Beispiel": ["membership_row", "person_page_intro"], "Zweite": ["membership_row"]}
    m = out["run_manifest"].first()
    assert (m.run_id, m.status, m.links.accepted, m.enrichment.enriched, m.entities["persons"]) == ("run7", "success", 2, 1, 2) and out["evidence_stubs"].count() == 1


def test_latest_pages_and_nodes(spark):
    pages = spark.createDataFrame([("A", 1, 1, "old", "s", "1", "u"), ("A", 1, 2, "new", "s", "2", "u"), ("A", 1, 2, "new", "s", "2", "u"), ("B", 2, 1, "b", "s", None, "u")], PAGE)
    assert sorted((r.page_title, r.html) for r in readers.latest_pages(pages).collect()) == [("A", "new"), ("B", "b")]
    rows = spark.createDataFrame([("p", "first", 1), ("p", "last", 2), (None, "none", 3)], "id string, name string, pos int")
    assert [(r.label, r.id, json.loads(r.properties)) for r in graph.nodes({"L": (rows, "id", ["pos"])}).collect()] == [("L", "p", {"id": "p", "name": "last"})]


def test_shared_folder(spark):
    class Session:
        conf = {"spark.master": "spark://host:7077"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        written.shared_dir(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert written.shared_dir(Session) == "hdfs://x/y"
    df = written.materialise(spark.range(3))
    written.discard(df, None, spark.range(1))
    assert not glob.glob(f"{df._written_to.removeprefix('file:')}/*")


UNSET = """
import glob, os
from pyspark.sql import SparkSession
from rosterlink.queries import all_queries
from rosterlink.sources import written

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
assert not spark.conf.get("spark.checkpoint.dir", None)
top = written.shared_dir(spark)
with written.job(spark) as folder:
    inner, kept = written.materialise(spark.range(3)), written.materialise(spark.range(4), keep=True)
    assert inner.count() == 3 and os.path.dirname(inner._written_to) == folder
assert not os.path.exists(folder) and kept.count() == 4
assert all_queries()[0]["party_counts"](spark, "/root/testdata/sf0.001").count() > 0
assert written.shared_dir(spark) == top and not spark.conf.get("spark.checkpoint.dir", None)
print("done")
"""


def test_a_session_without_a_shared_folder(tmp_path):
    """A real session of one process that names no folder: it gets one, and no setting changes."""
    (tmp_path / "conf").mkdir()
    root = pathlib.Path(__file__).resolve().parent.parent
    env = os.environ | {"PYTHONPATH": str(root), "SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run([sys.executable, "-c", UNSET], env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("done"), done.stderr[-2000:]


def test_markdown(spark):
    ref = (1, "table_row", 0, 4, "data", "Liste", ("Ada_B", 'A "B"'))
    docs = [("e1", ref, "membership_row"), ("e2", None, None)]
    refs = spark.createDataFrame(docs, f"evidence_id string, snippet_ref {members.SNIPPET_REF}, purpose string")
    index = spark.createDataFrame([("e1", "mediawiki", "Liste", 1, 2, "a" * 64), ("e2", "other", "X", 0, 0, None)], "evidence_id string, source_kind string, page_title string, page_id long, revision_id long, sha256 string")
    pages = spark.createDataFrame([("Liste", 1, 2, LIST, "s", "t", "u"), ("X", 0, 0, None, None, None, "http://x")], PAGE)
    out = evidence.resolve_evidence_refs(refs, index, pages)
    got = {r.evidence_id: r.markdown for r in evidence.as_markdown(out).collect()}
    assert got["e2"] == "- Evidence `e2`\n  - **Source**: other\n  - **Page**: X\n  - **URL**: http://x"
    lines = got["e1"].split("\n")
    assert lines[3:7] == ["  - **Revision**: 2", "  - **URL**: https://de.wikipedia.org/w/index.php?title=Liste&oldid=2", "  - **Retrieved**: t", "  - **SHA256**: `aaaaaaaaaaaaaaaa...`"] and lines[7] == "  - **Purpose**: membership_row"
    want = dict(zip(("version", "type", "table_index", "row_index", "row_kind", "title_hint"), ref)) | {"match": {"person_title": "Ada_B", "name_cell": 'A "B"'}}
    assert got["e1"].split("  - **Snippet Ref**: ")[1] == "```json\n" + json.dumps(want, ensure_ascii=False, indent=4) + "\n```"


def test_whole_job(spark, tmp_path):
    person = '<div class="mw-parser-output"><p>Ada Beispiel ist da.</p></div>'
    pages = spark.createDataFrame([("Liste", 1, 2, LIST, "s", "t", "u"), ("Ada_Beispiel", 3, 4, person, "s", "t", "u"), ("Liste", 1, 1, "<p>", "s", "s", "u")], PAGE)
    dip = spark.createDataFrame([(7, "Ada", "Beispiel", None, None, "X", [17], [], 0)], "dip_person_id long, vorname string, nachname string, namenszusatz string, titel string, fraktion string, wahlperiode array<int>, person_roles array<map<string,string>>, dip_pos int")
    out = run_pipeline(pages, _seed(spark), dip, None, "now")
    assert out["persons"].count() == 2 and out["assertions"].where("status = 'accepted'").count() == 1 and out["errors"].count() == 0
    assert {r.type for r in out["edges"].select("type").distinct().collect()} == {"SUPPORTED_BY", "HELD", "IN", "AFFILIATED_WITH", "HAS_SOURCE", "LINKS"}
    m = export({"persons": out["persons"].select("person_id", "name"), "none": out["errors"]}, str(tmp_path / "out"), "r", "now")
    assert {(r.entity, r.n) for r in m.collect()} == {("persons", 2), ("none", 0)} and not (tmp_path / "out" / "none").exists()


@pytest.mark.parametrize("url", ["http://a.B/p q/ü;x=1?b=2&a=&b=%C3%A4+c&c#f", "https://h", "https://h/%41?x=~*", "", "a b/ü?x=1"])
def test_normalize_url(spark, url):
    from urllib.parse import parse_qs, quote, urlencode, urlparse, urlunparse

    want = quote(url, safe="/:?#[]@!$&'()*+,;=")
    if url.startswith("http"):
        p = urlparse(url)
        want = urlunparse((p.scheme, p.netloc, quote(p.path, safe="/"), p.params, urlencode(parse_qs(p.query), doseq=True), p.fragment))
    assert spark.createDataFrame([(url,)], "u string").select(text.normalize_url(F.col("u"))).first()[0] == want


def test_references_of_search_documents(spark):
    ref = "struct<version:int,type:string,table_index:int,row_index:int>"
    docs = spark.createDataFrame([("p", None, {"e1": (1, "table_row", 0, 4), "e2": None}, ["e1"]), ("q", None, None, ["e3"])], f"person_id string, evidence_refs array<{members.EVIDENCE_REF}>, evidence_snippet_refs map<string,{ref}>, evidence_ids array<string>")
    assert [(r.person_id, r.evidence_id, r.snippet_ref.table_index, r.snippet_ref.row_index, r.purpose) for r in evidence.refs_of_documents(docs).collect()] == [("p", "e1", 0, 4, "membership_row")]
    assert [r.evidence_id for r in evidence.refs_of_documents(docs.where("person_id = 'q'")).collect()] == ["e3"]
