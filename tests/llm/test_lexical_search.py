"""Ranked search against a plain scorer."""

import collections
import math
import random
import re

import numpy as np

from rosterlink.llm import lexical_search as L

DOCS, ITEMS = "doc_id long, text string, n long, row long, terms string, score long, item long", "item_id long, text string, term string, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    vectors = [(i, collections.Counter(terms(t))) for i, t in docs]
    vectors = [(i, v, sum(v.values())) for i, v in vectors if v]
    n_docs, n_terms = len(vectors), sum(n for _, _, n in vectors)
    df = collections.Counter(t for _, v, _ in vectors for t in v)
    out = []
    for item, text in items:
        asked, scored = collections.Counter(terms(text)), []
        for i, v, n in vectors:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * v[t]) // (1000 * v[t] + 12 * m)) for t, q in asked.items() if v[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, *(None,) * 5) for d in docs], DOCS), spark.createDataFrame([(*i, None, None) for i in items], ITEMS)


def rows(out):
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(rng, n, words=400):
    weights = [1 / (k + 1) for k in range(words)]
    pool = [f"Wort{k}" if k % 3 else f"wörd{k}" for k in range(words)]
    return [(k, " ".join(rng.choices(pool, weights, k=rng.randrange(1, 120)))) for k in range(n)], pool, weights


def test_matches_a_plain_scorer(spark):
    rng = random.Random(2)
    docs, pool, weights = corpus(rng, 900)
    items = [(k, ", ".join(rng.choices(pool, weights if k % 2 else None, k=rng.randrange(1, 25)))) for k in range(40)]
    assert rows(L.search(*frames(spark, docs, items))) == plain(docs, items)
    assert rows(L.search(*frames(spark, docs, items), k=3, block_terms=60)) == plain(docs, items, 3)  # several passes


def test_closes_early_and_stays_exact(spark, monkeypatch):
    """Queries of rare and very common terms close before the common ones, which then are never joined."""
    rng = random.Random(3)
    docs = [(k, " ".join(["der"] * rng.randrange(1, 4) + [f"w{rng.randrange(60)}" for _ in range(30)] + [f"selten{k % 80}"] * 3)) for k in range(3000)]
    items = [(k, f"der selten{k} w{k}") for k in range(12)]
    seen, exact = [], L._exact
    monkeypatch.setattr(L, "_exact", lambda pairs, *rest: (seen.append(pairs.count()), exact(pairs, *rest))[1])
    assert rows(L.search(*frames(spark, docs, items))) == plain(docs, items)
    assert max(seen) < 12 * 3000 / 2  # most documents hold "der"; few have an accumulator


def test_odd_rows(spark):
    long = " ".join(f"w{k % 211}" for k in range(150_000))
    docs = [(1, "Alpha beta"), (1, "Alpha beta"), (2, "ALPHA-beta"), (None, "alpha, beta"), (3, None), (4, ""), (5, " .;\n"), (6, long), (7, "α β alpha é日本"), (8, "x y {z}")]
    items = [(1, "alpha"), (1, "alpha"), (None, "beta beta"), (2, None), (3, ""), (4, "nirgends"), (5, long), (6, "É日本 é日本"), (7, "x y z")]
    assert rows(L.search(*frames(spark, docs, items))) == plain(docs, items)
    d, i = frames(spark, docs, items)
    assert L.search(d.limit(0), i).count() == 0 and L.search(d, i.limit(0)).count() == 0 and L.search(d.where("text = ''"), i).count() == 0


def test_equal_scores_rank_by_id(spark):
    docs = [(k * 7919 % 1000, "eins zwei") for k in range(300)] + [(2000, "drei")]
    assert rows(L.search(*frames(spark, docs, [(1, "eins")]))) == plain(docs, [(1, "eins")])


def test_terms_that_share_a_hash(monkeypatch):
    """Terms are compared byte by byte, whatever their hashes."""
    words, spans = ["ab", "cd", "ef", "abc"], L.word_spans
    monkeypatch.setattr(L, "word_spans", lambda *a, **b: (lambda h, *rest: (h % np.uint64(2), *rest))(*spans(*a, **b)))
    v, data = L.Vocabulary(words), np.frombuffer(b"AB ef xx abc CD ab", np.uint8)
    h, _, start, end = L.word_spans(data, np.array([0, len(data)]), breaks=L.BREAKS)
    assert v.find(data, start, end, h).tolist() == [0, 2, -1, 3, 1, 0]
