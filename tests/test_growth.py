"""Work per page and per reference: parsed once, tried once, in as many parts as there are partitions."""

import random

import pytest
from pyspark.sql import functions as F

from rosterlink.functions import dom
from rosterlink.functions.text import parse_date
from rosterlink.operators import evidence, members, persons
from rosterlink.queries import records, render

SF = "/root/testdata/sf0.001"


def _expressions(df, name):
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


def test_ids_of_person_pages_need_no_parsing(spark):
    pages = render.person_pages(spark, SF)
    ids = persons.person_page_ids(pages)
    assert _expressions(ids, "MapInArrow") == 0
    facts = persons.person_facts(pages).select("wikipedia_title", "evidence_id")
    assert ids.exceptAll(facts).isEmpty() and facts.exceptAll(ids).isEmpty()


@pytest.mark.parametrize("name", ["evidence_leads", "evidence_formats", "evidence_references"])
def test_evidence_queries_parse_pages_once(spark, monkeypatch, name):
    calls = []
    for module in (evidence, persons):
        monkeypatch.setattr(module, "with_dom", lambda *a, **k: calls.append(a) or dom.with_dom(*a, **k))
    records.QUERIES[name](spark, SF)
    assert len(calls) == 1


def test_both_forms_are_those_of_each(spark):
    pages = render.person_pages(spark, SF).limit(20)
    out = evidence.resolve_evidence_ids(persons.person_page_ids(pages), evidence.rebuild_index(pages.drop("html")), pages, 40)
    each = evidence.as_markdown(out).join(evidence.as_json(out), "evidence_id")
    assert sorted(map(tuple, evidence.as_both(out).collect())) == sorted(map(tuple, each.collect()))


def test_a_date_is_tried_once(spark):
    rows = spark.createDataFrame([("3. März 2010",), ("3. ma 2010",), ("1.5.2001",), ("2001-5-1",), ("",), (None,)], "t string").select(parse_date(F.col("t")).alias("d"))
    assert _expressions(rows, "regexp_extract") <= 3
    assert [r.d for r in rows.collect()] == ["2010-03-03", None, "2001-05-01", "2001-05-01", None, None]


def test_plain_pages_need_one_pattern(monkeypatch):
    fed, feed = [], dom._Builder.feed
    monkeypatch.setattr(dom._Builder, "feed", lambda self, rest: fed.append(rest) or feed(self, rest))
    page = dom.parse('<div class="mw-parser-output"><p>a <b>b</b></p><table class="wikitable"><tr><th>Name</th></tr><tr><td><a title="x">y</a></td></tr></table></div>')
    assert fed == [""] and page["tables"][0]["rows"][1][0]["link_title"] == "x" and page["intro_parts"] == ["a b"]


def test_patterns_and_the_standard_parser_agree(monkeypatch):
    rng, parts = random.Random(1), "<table>|<table class=\"wikitable\">|</table>|<tr>|<td>|</td>|<th>|<p>|</p>|<div class=\"mw-parser-output\">|</div>|<h2>x</h2>|<a title=\"q\">|</a>|<br>|<br/>|<template>|</template>|<script>a<p>|</script>|x|&amp;|<!-- c -->|<TD>|<td a=\"&lt;\">|<|</td a=\"1\">".split("|")
    pages = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    got = [dom.parse(p) for p in pages]
    monkeypatch.setattr(dom._Builder, "read", lambda self, html: (self.feed(html), self.close()))
    assert got == [dom.parse(p) for p in pages]


def test_list_pages_stay_in_parts(spark):
    parsed = members.member_pages(render.list_pages(spark, SF), render.seeds(spark, SF))
    assert len(parsed.inputFiles()) > 1
    assert parsed.count() == 25
