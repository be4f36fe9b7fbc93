"""Stored tables by key: upserts, runs over what changed, term lookups, exports counted while they are written, linear parsing."""

import glob
import hashlib
import json
import os
import random
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from rosterlink.functions.dom import parse
from rosterlink.operators import evidence
from rosterlink.plans import jobs
from rosterlink.queries import all_queries
from rosterlink.sinks.export import export, write_seeds
from rosterlink.sources.keyed_table import KeyedTable
from rosterlink.sinks.term_index import TermIndex

PAGE = "page_title string, page_id long, revision_id long, html string, sha256 string, retrieved_at string, url string"
SEED = "seed_pos int, key string, page_title string, expected_start string, expected_end string, parliament string, state string, legislature_number int, section_keywords array<string>"
DIP = "dip_person_id long, vorname string, nachname string, namenszusatz string, titel string, fraktion string, wahlperiode array<int>, person_roles array<map<string,string>>, dip_pos int"


def files(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/rows/*/*.parquet")}


def test_an_upsert_touches_its_own_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable.write(spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v")), path, "k", 200)
    before = files(path)
    batch = spark.createDataFrame([(str(k), f"new{n}", n) for k in (3, 77, 4999, 9001) for n in (1, 2)] + [(None, "x", 3)], "k string, v string, n int")
    touched = KeyedTable.open(spark, path).upsert(batch, ["n"])
    after = files(path)
    folder = lambda f: f.split("/bucket=")[1].split("/")[0]
    changed = {folder(f) for f in set(before) ^ set(after)} | {folder(f) for f in set(before) & set(after) if before[f] != after[f]}
    assert touched == len(changed) <= 4 and len(before) >= 190
    want = {str(k): "old" for k in range(5000)} | {k: "new2" for k in ("3", "77", "4999", "9001")}
    assert {r.k: r.v for r in table.rows().collect()} == want and table.rows().count() == len(want)
    table.upsert(batch, ["n"])
    assert {r.k: r.v for r in table.rows().collect()} == want and table.rows().count() == len(want)
    assert table.upsert(batch.limit(0), ["n"]) == 0
    assert {r.k for r in table.rows_of(spark.createDataFrame([("77",), ("none",)], "k string")).collect()} == {"77"}


def page(title, k, rev, members=None):
    if members is None:
        return (title, k, rev, f'<div class="mw-parser-output"><p>{title} ist da, Fassung {rev}.</p></div>', f"s{k}-{rev}", f"2024-{rev:04d}", "u")
    rows = "".join(f'<tr><td><a title="{m}">{m}</a></td><td>{p}</td></tr>' for m, p in members)
    return (title, k, rev, f'<div class="mw-parser-output"><table class="wikitable"><tr><th>Name</th><th>Partei</th></tr>{rows}</table></div>', f"s{k}-{rev}", f"2024-{rev:04d}", "u")


def test_a_run_over_what_changed_equals_a_full_run(spark, tmp_path):
    """A second run parses the one list that changed and the one person it adds; a third one nothing."""
    state = str(tmp_path / "state")
    seeds = spark.createDataFrame([(k, f"k{k}", f"Liste {k}", "2000-01-01", "", "P", "S", k, []) for k in (1, 2, 3)], SEED)
    dip = spark.createDataFrame([(7, "Ada", "Eins", None, None, "X", [17], [], 0)], DIP)
    first = [page("Liste 1", 1, 1, [("Ada Eins", "A"), ("Bea Zwei", "B")]), page("Liste 2", 2, 1, [("Cem Drei", "A")]), page("Liste 3", 3, 1, [("Ada Eins", "C")])]
    first += [page("Ada Eins", 11, 1), page("Bea Zwei", 12, 1), page("Dora Vier", 14, 1), page("Andere", 15, 1)]
    second = [*first, page("Liste 2", 2, 2, [("Cem Drei", "B"), ("Dora Vier", "D")]), page("Andere", 15, 2)]
    third = [*second, page("Ada Eins", 11, 5)]
    names = ("persons", "parties", "mandates", "evidence", "edges", "nodes", "assertions", "errors", "person_documents")
    for raw, want in ((first, {"Liste_1", "Liste_2", "Liste_3", "Ada_Eins", "Bea_Zwei"}), (second, {"Liste_2", "Dora_Vier"}), (second, set()), (third, {"Ada_Eins"})):
        pages = spark.createDataFrame(raw, PAGE)
        out, full = jobs.run_changed(pages, state, seeds, dip, None, "now"), jobs.run_pipeline(pages, seeds, dip, None, "now")
        assert {r.page_title for r in out["parsed_titles"].collect()} == want
        for name in names:
            assert sorted(map(repr, out[name].select(*sorted(out[name].columns)).collect())) == sorted(map(repr, full[name].select(*sorted(full[name].columns)).collect())), name


def test_a_changed_or_dropped_seed(spark, tmp_path):
    state, dip = str(tmp_path / "state"), spark.createDataFrame([], DIP)
    pages = spark.createDataFrame([page(f"Liste {k}", k, 1, [(f"P {k}", "A")]) for k in (1, 2)], PAGE)
    seed = lambda k, start: (k, f"k{k}", f"Liste {k}", start, "", "P", "S", k, [])
    for rows, want, names in (([seed(1, "2000-01-01"), seed(2, "2000-01-01")], {"Liste_1", "Liste_2"}, {"P 1", "P 2"}), ([seed(1, "2001-01-01")], {"Liste_1"}, {"P 1"})):
        out = jobs.run_changed(pages, state, spark.createDataFrame(rows, SEED), dip, None, "now")
        assert {r.page_title for r in out["parsed_titles"].collect()} == want and {r.name for r in out["persons"].collect()} == names
        assert {r.start_date for r in out["mandates"].collect()} == {rows[0][3]}


def test_terms_find_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(6)
    parts = ["Ada", "adam", "von", "der", "Weiß", "a_b", "Ünal", "x-y"]
    people = [(f"p{k}", " ".join(rng.choices(parts, k=rng.randrange(1, 4))), "_".join(rng.choices(parts, k=2))) for k in range(300)] + [("null", None, None), (None, "Ada", "Ada")]
    docs = spark.createDataFrame(people, "person_id string, name string, wikipedia_title string")
    index = TermIndex.write(docs, str(tmp_path / "terms"), "person_id", ("name", "wikipedia_title"), "name")
    for query in ("ada", "AD ei", "der von a", "ada von der weiß", "a_b", "ün x-", "nix", "  "):
        got = {r.id for r in index.matches(spark.createDataFrame([(query,)], "query string")).collect()}
        scan = {r.person_id for r in evidence.find_persons(docs.where("person_id is not null"), query, 10_000).collect()} if query.strip() else set()
        assert got == scan, query
    assert [r.id for r in index.first("ada", 5).collect()] == [r.person_id for r in evidence.find_persons(docs.where("person_id is not null"), "ada", 5).collect()]
    empty = TermIndex.write(docs.limit(0), str(tmp_path / "empty"), "person_id", ("name", "wikipedia_title"), "name")
    assert empty.first("ada").count() == 0 and TermIndex.open(spark, str(tmp_path / "terms")).first("ada", 5).count() == 5


def test_an_export_works_every_table_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    tables = {"rows": spark.range(40).mapInArrow(count, "id long"), "none": spark.range(0), "more": spark.range(3)}
    got = {r.entity: r.n for r in export(tables, str(tmp_path / "out"), "r", "now").collect()}
    assert got == {"rows": 40, "none": 0, "more": 3} and seen.value == 40
    assert sorted(os.listdir(tmp_path / "out")) == ["manifest", "more", "rows"]


def test_seeds_are_written_by_key(spark, tmp_path):
    write_seeds(spark.createDataFrame([("c", 1), ("a", 2), ("b", 3)], "key string, n int"), str(tmp_path / "seeds"))
    lines = [json.loads(x) for f in sorted(glob.glob(f"{tmp_path}/seeds/part-*")) for x in open(f)]
    assert [x["key"] for x in lines] == ["a", "b", "c"]


def test_a_page_of_many_tables_and_headings_parses_in_linear_time():
    def took(n):
        table = '<table class="wikitable"><tr><th>Name</th></tr><tr><td>x</td></tr></table>'
        html = "".join(f"<h2>H{k}</h2>{table}" for k in range(n)) + "<h3>Ende</h3>"
        began = time.process_time()
        dom = parse(html)
        assert len(dom["tables"]) == len(dom["heading_tables"]) == n and {t["index"] for t in dom["tables"]} == {0}
        assert [h["table_pos"] for h in dom["heading_tables"]] == list(range(n))
        return time.process_time() - began

    took(200)
    assert took(20_000) < 40 * max(took(1_000), 0.02)


def test_equal_tables_have_the_index_of_the_first():
    a, b = '<table class="wikitable"><tr><td a="1" b="2">x</td></tr></table>', '<table class="wikitable"><tr><td>x</td></tr></table>'
    same = a.replace('a="1" b="2"', 'b="2" a="1"')
    assert [t["index"] for t in parse(b + a + b + same + "<table><tr><td>x</td></tr></table>")["tables"]] == [0, 1, 0, 1, 0]


class Paragraphs(HTMLParser):
    """Texts of the paragraphs within the first article, by open elements alone: no tree."""

    VOID = set("area base br col embed hr img input link meta param source track wbr".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.found, self.article = [], [], None

    def handle_starttag(self, tag, attrs):
        if tag == "article" and self.article is None:
            self.article = len(self.open)
        elif tag == "p" and self.article is not None and self.inside():
            self.found.append(["", len(self.open) == self.article + 1])
        if tag not in self.VOID:
            self.open.append((tag, len(self.found) - 1 if tag == "p" and self.inside() else None))

    def inside(self):
        return self.article is not None and self.article >= 0 and any(t == "article" for t, _ in self.open[self.article : self.article + 1])

    def handle_endtag(self, tag):
        tags = [t for t, _ in self.open]
        if tag in tags:
            at = len(tags) - 1 - tags[::-1].index(tag)
            if self.article is not None and at <= self.article:
                self.article = -1  # the first article is over
            del self.open[at:]

    def handle_data(self, data):
        last = max((k for k, (t, _) in enumerate(self.open) if t in ("script", "style", "template")), default=-1)
        for k, (t, p) in enumerate(self.open):
            if p is not None and k > last:
                self.found[p][0] += data


def test_paragraphs_of_raw_pages(spark):
    """``page_paragraphs`` against a parser that keeps no tree."""
    want = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html").collect():
        parser = Paragraphs()
        parser.feed(r.html or "")
        parser.close()
        for pos, (text, direct) in enumerate(parser.found):
            want[(r.page_id, pos)] = (direct, len(text), hashlib.sha256(text.encode()).hexdigest())
    got = {(r.page_id, r.pos): (r.is_direct_child, r.n_chars, r.sha256) for r in all_queries()[0]["page_paragraphs"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want and len(got) > 50
