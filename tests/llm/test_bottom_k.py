"""Near duplicates by sketches, and the rounds of links that both joins share, against brute force."""

import random

from pyspark.sql import functions as F
from test_llm import LONG, NAMES, TEXTS, brute

from rosterlink.llm import star_links as S
from rosterlink.llm.bottom_k import bottom_k_components, near_duplicates
from rosterlink.llm.ngram_join import ngram_jaccard_components

SCHEMA = "doc_id long, text string"


def found(out):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}


def changed(rng, words, most):
    copy = list(words)
    for _ in range(rng.randrange(most)):
        copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
    return " ".join(copy)


def test_matches_brute_force(spark):
    rng, rows = random.Random(11), []
    for length in (3, 9, 20, 60, 140, 700):  # sets smaller and larger than a sketch
        words = [f"w{rng.randrange(900)}" for _ in range(length)]
        rows += [(len(rows) + k, changed(rng, words, 2 + length // 18)) for k in range(22)]
    whole = [f"g{k}" for k in range(200)]
    rows += [(len(rows) + k, " ".join(whole[: 200 - 9 * k])) for k in range(8)]  # parts of one text
    shared = " ".join(f"s{k}" for k in range(60))
    rows += [(len(rows) + k, f"{shared} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for k in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for size in (4, 5):
        assert found(bottom_k_components(docs, size=size)) == brute(rows, size)


def test_a_third_of_all_rows_in_one_group(spark):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(150)]
    rows = [(k, " ".join(words)) for k in range(150)] + [(150 + k, changed(rng, words, 9)) for k in range(150)]
    rows += [(300 + k, " ".join(f"o{rng.randrange(50)}" for _ in range(80))) for k in range(150)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), size=4).collect()
    want = brute(rows, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert {r.doc_id for r in got if r.kept} == {i for i, (_, c) in want.items() if i == c}


def test_odd_rows(spark):
    odd = spark.createDataFrame([(i, t, *(None,) * len(NAMES)) for i, t in TEXTS], "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))
    got = near_duplicates(odd, size=4)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and dict(got.dtypes)["n_shingles"] == "bigint"
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert (0, 4, 0, True) in rows and (1, 4, 0, False) in rows and (2, 0, 2, True) in rows and (3, 0, 3, True) in rows and (4, 0, 4, True) in rows and (5, 1, 5, True) in rows and (6, 1, 5, False) in rows
    assert (None, 1, None, True) in rows and sum(r[0] == 7 and r[3] for r in rows) == 2 and len(rows) == len(TEXTS)
    assert near_duplicates(odd.limit(0)).count() == 0
    assert len(LONG) > 300_000


def test_signatures_never_drop_a_link():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (5, 100, 3000):
        both = rng.integers(0, 2**63, n).astype(np.uint64)
        for extra in (0, 1, n // 9, n // 5):
            other = np.concatenate([both, rng.integers(0, 2**63, extra).astype(np.uint64)])
            bits = sum((x ^ y).bit_count() if (x ^ y) >= 0 else ((x ^ y) + 2**64).bit_count() for x, y in zip(S.signature(np.unique(both)), S.signature(np.unique(other))))
            assert bits <= len(np.setxor1d(both, other))


def jobs(spark, run):
    group = f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return out, n


def test_texts_that_share_a_passage_and_never_link_take_no_more_jobs(spark):
    """3000 texts that share an n-gram no other text has: some four million pairs, looked at in one job."""
    rng = random.Random(13)

    def texts(n):
        return [(k, "the rare words they share " + " ".join(f"u{rng.randrange(10**7)}" for _ in range(20))) for k in range(n)]

    few, many = texts(300), texts(3000)
    few_out, few_jobs = jobs(spark, lambda: ngram_jaccard_components(spark.createDataFrame(few, SCHEMA)).where("component_id <> doc_id").count())
    many_out, many_jobs = jobs(spark, lambda: ngram_jaccard_components(spark.createDataFrame(many, SCHEMA)).where("component_id <> doc_id").count())
    assert few_out == many_out == 0 and many_jobs <= few_jobs + 10


def test_every_pair_of_large_tokens(spark):
    """The lanes of a token, together, look at each pair once."""
    n = 3 * S.TASK_ROWS
    rows = spark.range(n).select(F.lit(1).cast("long").alias("token"), F.col("id").alias("node"), F.lit(0).alias("pos"), F.lit(100).alias("n"), F.col("id").alias("c"), F.lit(n).cast("long").alias("k"), F.lit(0).cast("long").alias("main"))
    close = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") % 1000 == 7, F.array(*[F.lit(0).cast("long")] * 16)).otherwise(F.array(*[F.xxhash64("id", F.lit(k)) for k in range(16)])).alias("sig"))
    pairs = {tuple(r) for r in S._every_pair(rows, close, 80).collect()}
    alike = range(7, n, 1000)
    assert pairs == {(a, b) for a in alike for b in alike if a < b}
