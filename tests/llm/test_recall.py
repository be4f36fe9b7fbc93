"""Decontamination: recall under substitution, and the same rows when test hashes are too many to broadcast."""

import random

import pytest

from rosterlink.llm import decontamination as D

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


@pytest.fixture(scope="module")
def planted(spark):
    """Items of 40 words, each in documents with a share of its words substituted, and documents of other words."""
    rng = random.Random(9)
    items = [(k, " ".join(f"w{rng.randrange(4000)}" for _ in range(40))) for k in range(60)]
    docs, share_of = [], {}
    for share in (0.0, 0.1, 0.2, 0.25, 0.28):
        for k, text in items:
            words = text.split()
            for at in rng.sample(range(40), round(40 * share)):
                words[at] = f"x{rng.randrange(10**6)}"
            share_of[len(docs)] = (share, k)
            docs.append((len(docs), " ".join([*(f"v{rng.randrange(4000)}" for _ in range(30)), *words, *(f"v{rng.randrange(4000)}" for _ in range(30))])))
    clean = [(10_000 + k, " ".join(f"w{rng.randrange(4000)}" for _ in range(200))) for k in range(100)]
    return spark.createDataFrame(docs + clean, DOCS).cache(), spark.createDataFrame(items, ITEMS).cache(), share_of


def found(planted):
    docs, items, _ = planted
    return {(r.doc_id, r.item_id): r.matched for r in D.contaminated(docs, items).collect()}


def test_recall_under_substitution(planted):
    got, (_, _, share_of) = found(planted), planted
    recall = {s: sum((d, k) in got for d, (t, k) in share_of.items() if t == s) / 60 for s in {t for t, _ in share_of.values()}}
    assert all(recall[s] == 1.0 for s in (0.0, 0.1)) and recall[0.2] >= 0.98 and recall[0.25] >= 0.95 and recall[0.28] >= 0.85, recall
    assert not [d for d, _ in got if d >= 10_000] and all(share_of[d][1] == k for d, k in got)


def test_many_test_hashes_give_the_same_rows(planted, monkeypatch):
    want = found(planted)
    monkeypatch.setattr(D, "BROADCAST_SEEDS", 0)
    for words in (1 << 4, 1 << 10):  # a bitmap that is nearly full, and one that is nearly empty
        monkeypatch.setattr(D, "WORDS", words)
        assert found(planted) == want


def test_the_bitmap_drops_what_meets_nothing(spark, planted, monkeypatch):
    """What is shuffled towards the test hashes are the document's hashes that may meet one, not all of them."""
    docs, items, _ = planted
    seeds = D._seeds(items.select("item_id", D.word_hashes(items["text"]).alias("h")), "item_id").where("key is not null").select("item_id", "key")
    every = D._seeds(docs.select("doc_id", D.word_hashes(docs["text"]).alias("h")), "doc_id")
    monkeypatch.setattr(D, "BROADCAST_SEEDS", 0)
    met = D._met(every, seeds)
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftrightunsigned" in plan and met.select("doc_id").distinct().count() <= 300


def test_contradicting_labels_count_as_the_smaller(spark):
    from rosterlink.llm.common import labelled_sample

    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], DOCS)
    rows = [(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (3, 1), (4, 7)]
    for order in (rows, rows[::-1]):
        labels = spark.createDataFrame(order, "doc_id long, label int").repartition(3)
        assert sorted((r.text, r.label) for r in labelled_sample(docs, labels).collect()) == [("a", 0), ("b", 1), ("c", 1)]
