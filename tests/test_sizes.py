"""Work that is done once, whatever the size: a tag's text is read once, a parsed page written once, a person's rows shuffled once."""

from rosterlink.functions import dom
from rosterlink.operators import members, normalize
from rosterlink.queries import records, render
from rosterlink.sinks import graph

SF = "/root/testdata/sf0.001"


def test_a_tag_is_read_once(monkeypatch):
    read, plain = [], dom._plain_tag
    monkeypatch.setattr(dom, "_plain_tag", lambda text: read.append(text) or plain(text))
    monkeypatch.setattr(dom, "_tags", {})
    page = dom.parse("<table>" + '<tr><td class="a">x</td></tr>' * 500 + "</table>")
    assert sorted(read) == ["/table", "/td", "/tr", "table", 'td class="a"', "tr"]
    assert len(page["tables"][0]["rows"]) == 500


def test_the_tags_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(dom, "_tags", {})
    page = dom.parse("".join(f'<p id="{k}">x</p>' for k in range(3 * dom._MOST_TAGS)) + f'<p id="{"y" * 1000}">')
    assert len(dom._tags) <= dom._MOST_TAGS and max(map(len, dom._tags)) <= dom._LONGEST_TAG
    assert page["tables"] == []


def test_tags_share_no_state(monkeypatch):
    """Elements of one tag text are elements of their own."""
    monkeypatch.setattr(dom, "_tags", {})
    page = dom.parse('<div class="mw-parser-output"><p>a</p><p>b</p></div>' * 2)
    assert [p["text"] for p in page["paragraphs"]] == ["a", "b"] and page["intro_parts"] == ["a", "b"]


def test_list_pages_are_written_once(spark, monkeypatch):
    written, keep = [], members.materialise
    monkeypatch.setattr(members, "materialise", lambda df, *a: written.append(df.columns) or keep(df, *a))
    monkeypatch.setattr(dom, "materialise", lambda df, *a: written.append(df.columns) or keep(df, *a))
    parsed = members.member_pages(render.list_pages(spark, SF), render.seeds(spark, SF))
    assert len(written) == 1 and "dom" not in written[0]
    assert parsed.where("error is null").count() == 25


def _persons(spark):
    refs = f"array<{members.EVIDENCE_REF}>"
    row = lambda k: (1, "table_row", 0, k, "data", "l", ("t", None))
    return spark.createDataFrame(
        [
            ("a", "A1", "t", "u", 1, 1, ["e2"], [("e2", row(0), "m", None, "2001"), ("e1", None, "m", None, "2003")]),
            ("a", "A2", "t", "u", 1, 2, ["e1", "e2"], [("e2", row(0), "m", None, "2000"), ("e2", row(1), "m", None, "2000"), ("e1", None, None, None, "2002")]),
            ("a", "A0", "t", "u", 0, 9, ["e2"], [("e2", row(0), "m", None, "2000"), ("e1", None, "m", None, "2002")]),
            ("b", "B", "t", "u", 0, 0, None, None),
        ],
        f"person_id string, name string, wikipedia_title string, wikipedia_url string, seed_pos int, row_index int, evidence_ids array<string>, evidence_refs {refs}",
    )


def test_rows_of_persons_are_shuffled_once(spark):
    merged = normalize.merge_persons(_persons(spark))
    assert merged._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {r.person_id: r for r in merged.collect()}
    refs = [(r.evidence_id, r.snippet_ref and r.snippet_ref.row_index, r.purpose, r.created_at) for r in got["a"].evidence_refs]
    assert refs == [("e1", None, None, "2002"), ("e1", None, "m", "2002"), ("e2", 0, "m", "2000"), ("e2", 1, "m", "2000")]
    assert got["a"].name == "A2" and got["a"].evidence_ids == ["e1", "e2"]
    assert got["b"].evidence_refs == [] and got["b"].evidence_ids == []


def test_edges_are_distinct_without_sorting(spark):
    edges = graph.supported_by(normalize.merge_persons(_persons(spark)), "person_id", "Person")
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("first(") == 0
    assert sorted((e.src, e.dst, e.purpose) for e in edges.collect()) == [("a", "e1", ""), ("a", "e1", "m"), ("a", "e2", "m"), ("a", "e2", "m")]


def test_a_json_text_is_read_once_for_its_values(spark):
    plan = records.evidence_json(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") == 0 and plan.count("from_json(StructField(snippet_ref") == 1 and plan.count("jsonObjectKeys(") == 1


def test_stubs_move_ids_alone(spark):
    """Edges need not be distinct before their targets are."""
    index = spark.createDataFrame([("e2",)], "evidence_id string")
    stubs = graph.evidence_stubs(graph.supported_by(_persons(spark), "person_id", "Person"), index)
    assert stubs._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert [r.evidence_id for r in stubs.collect()] == ["e1"]
