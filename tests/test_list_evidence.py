from rosterlink.operators import normalize
from rosterlink.queries import roster

SF = "/root/testdata/sf0.001"


def test_urls_of_list_evidence(spark):
    """The query names pages as its SQL does, the operator encodes their titles."""
    url = lambda title, r: f"https://de.wikipedia.org/wiki/{title}?oldid={r['revision_id']}"
    shown = roster.list_evidence(spark, SF).collect()
    made = normalize.evidence(roster._parsed(spark, SF)).collect()
    assert len(shown) == len(made) == 25
    assert all(r["source_url"] == url(r["page_title"], r) for r in shown)
    assert all(r["source_url"] == url(r["page_title"].replace("_", "%20"), r) for r in made)
