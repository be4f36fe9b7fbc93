"""Stages of the pipeline against plain versions of what they decide."""

import re

import numpy as np
from test_llm import SF, SMALL, plain_fold, plain_weight

from rosterlink.llm.common import held_out, labelled_sample
from rosterlink.llm.toxicity import fit_lexicon

MASKS = ("1110111", "110100111", "1100101011")


def rows(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]


def test_the_toxicity_stage_drops_what_a_plain_search_scores_high(spark):
    import corpus_pipeline as P

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(labels.where("toxic = 1 or doc_id < 200").select("doc_id"), "doc_id", "left_semi").where("length(text) < 4000")
    lexicon = fit_lexicon(labelled_sample(docs, labels.where(~held_out("doc_id", 3, 1)), label_col="toxic"))
    a, b, c = lexicon.calibration

    def score(text):
        text = plain_fold(text or "")
        x, n = plain_weight(text, lexicon), len(text.split())
        return 1 / (1 + np.exp(-(np.log1p(x) * a + x / np.sqrt(n + 1) * b + c)))

    want = {r.doc_id for r in docs.collect() if score(r.text) < 0.7}
    assert {r.doc_id for r in P.toxicity(spark, docs, SF).collect()} == want and len(want) < docs.count()


def held(doc, item, window=25):
    """Whether the document's words hold a window of the item's around some place where a mask agrees: every place is tried."""
    places = {(i, k) for m in MASKS for i in range(len(item) - len(m) + 1) for k in range(len(doc) - len(m) + 1) if all(item[i + x] == doc[k + x] for x in range(len(m)) if m[x] == "1")}
    for i, k in places:
        begin = min(max(i + 4 - window // 2, 0), max(len(item) - window, 0))
        said, at = item[begin : begin + window], k - (i - begin)
        agree = sum(any(0 <= at + j + d < len(doc) and doc[at + j + d] == w for d in (-1, 0, 1)) for j, w in enumerate(said))
        if agree >= 0.7 * len(said):
            return True
    return False


def test_the_decontamination_stage_drops_what_every_place_tried_finds(spark):
    import corpus_pipeline as P

    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 2500")
    items = [words(t) for _, t in rows(spark, "benchmark")]
    grams = [{tuple(x[i : i + 2]) for i in range(len(x) - 1)} for x in items]
    want = set()
    for i, t in docs.select("doc_id", "text").collect():
        w = words(t)
        pairs = {tuple(w[k : k + 2]) for k in range(len(w) - 1)}
        # a mask begins with two words that count, so a document without such a pair of the item has no place to try
        if not any(len(g & pairs) > 3 and held(w, item) for g, item in zip(grams, items)):
            want.add(i)
    got = {r.doc_id for r in P.decontamination(spark, docs, SMALL).collect()}
    assert got == want and len(got) < docs.count()
