"""Linking by name classes: the best three of every record, as all pairs would give them."""

import itertools
import random
import time

from pyspark.sql import functions as F

from rosterlink.operators import linking

DIP = "dip_person_id long, vorname string, nachname string, namenszusatz string, dip_pos int"


def best_of_all_pairs(spark, wiki, dip):
    """By brute force: every pair scored, sorted, cut to three."""
    pairs = linking.wiki_keys(wiki).join(F.broadcast(linking.dip_keys(dip)), F.lit(True)).withColumn("score", linking.score()).where("score >= 0.5").collect()
    out = set()
    for k, group in itertools.groupby(sorted(pairs, key=lambda r: (r.wiki_id, -r.score, r.dip_pos)), key=lambda r: r.wiki_id):
        group = list(group)
        out |= {(k, r.dip_person_id, r.dip_pos, r.score, n, group[0].score, group[1].score if len(group) > 1 else 0.0) for n, r in enumerate(group[:3], 1)}
    return out


def found(wiki, dip):
    return {tuple(r) for r in linking.best_candidates(wiki, dip).collect()}


def test_best_three_are_those_of_all_pairs(spark):
    rng = random.Random(4)
    firsts, lasts, middles = ["Ada", "Eva", "Groß", "Gross", "Jürgen", ""], ["Weiß", "Weiss", "Kurz", "von Kurz", "Ada", ""], ["", "", "Maria", "von der", "Jr."]
    wiki = [(f"w{k}", " ".join(x for x in (rng.choice(firsts), rng.choice(middles), rng.choice(lasts)) if x)) for k in range(250)] + [("w-null", None), ("w-empty", " ")]
    dip = [(k % 170, rng.choice(firsts), rng.choice(lasts), rng.choice([*middles, None]), k) for k in range(200)]
    w, d = spark.createDataFrame(wiki, "id string, name string"), spark.createDataFrame(dip, DIP)
    want = best_of_all_pairs(spark, w, d)
    assert found(w, d) == want and len(want) > 300
    assert not found(w.limit(0), d) and not found(w, d.limit(0))


def test_a_hundred_thousand_namesakes(spark):
    """One surname on both sides, with the same and with different first names: time and rows grow with the records."""

    def run(n):
        wiki = spark.range(n).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 2 == 0, "Eva Kurz").otherwise(F.concat(F.lit("N"), F.col("id").cast("string"), F.lit(" Kurz"))).alias("name"))
        dip = spark.range(n).select(F.col("id").alias("dip_person_id"), F.when(F.col("id") % 4 == 0, "Eva").otherwise(F.concat(F.lit("N"), F.col("id").cast("string"))).alias("vorname"), F.lit("Kurz").alias("nachname"), F.lit(None).cast("string").alias("namenszusatz"), F.col("id").cast("int").alias("dip_pos"))
        began = time.time()
        out = linking.best_candidates(wiki, dip)
        got = out.agg(F.count("*"), F.countDistinct("wiki_id"), F.count_if(F.expr("rn = 1 and best = 0.95 and second = 0.5")), F.count_if(F.expr("rn = 1 and second = 0.95")), F.sum(F.when(F.col("rn") == 1, F.col("dip_pos")))).first()
        return tuple(got), time.time() - began

    small, large = 1_000, 100_000
    for n in (small, large):
        got, took = run(n)
        # even records are Eva, with three equal Evas first; an odd one has its own name next to two that only share the surname
        assert got == (3 * n, n, n // 2, n // 2, sum(range(1, n, 2))), n
    assert took < 120
