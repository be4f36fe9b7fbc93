"""The Merkle manifest against a tree built with plain Python."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from rosterlink.llm.merkle import FAN, fold, lower_case_tampered, merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, tree long, pos long, path string, block long"


def h(*values):
    return hashlib.sha256(b"".join(b"-" if v is None else str(len(str(v).encode())).encode() + b":" + str(v).encode() for v in values)).hexdigest()


def joined(digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def tree(leaves):
    """The last node, and each leaf's siblings from below as (left, right)."""
    paths, nodes, of = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for leaf, at in enumerate(of):
            run = at // FAN * FAN
            paths[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + FAN])))
        nodes, of = [joined(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)], [at // FAN for at in of]
    return nodes[0], paths


def manifest(rows):
    """(id, leaf, subroot, root, siblings, leaf after tampering) of rows (id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, out = [], []
    for s in order:
        mine = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, h(*r)))
        top, paths = tree([h(*r) for r in mine])
        subroots.append(top)
        out.append((mine, top, paths))
    root, above = tree(subroots)
    done = []
    for (mine, top, paths), over in zip(out, above):
        for r, path in zip(mine, paths):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]) if r[4] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]
            done.append((r[0], h(*r), top, root, path + over, h(*r[:4], low)))
    return done


def rows_of(got):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path], r.candidate) for r in got.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, *(None,) * 5) for i, s, lang, n, t in rows], SCHEMA)


def test_sources_of_many_sizes(spark):
    rng, sizes = random.Random(1), {"one": 1, "two": 2, "run": 16, "over": 17, "level": 256, "more": 257, "Hot": 1500}
    rows = [(k * 7 % 3001, source, "de", k, f"Text {k} ÄÖ") for source, n in sizes.items() for k in range(n)]
    rows += [(10_000 + k, rng.choice([None, "", "a", "Z", "é", "zz"]), None, None, f"Wort {k}") for k in range(40)]
    assert rows_of(merkle_manifest(frame(spark, rows), changed={"text": lower_case_tampered()})) == sorted(manifest(rows), key=repr)


def test_many_sources(spark):
    rows = [(k, f"source{k % 331}", "en", 1, f"A{k}") for k in range(700)]
    assert rows_of(merkle_manifest(frame(spark, rows), changed={"text": lower_case_tampered()})) == sorted(manifest(rows), key=repr)


def test_proofs_fold_to_the_root_unless_the_row_changed(spark):
    rows = [(k, f"s{k % 3}", "en", 1, f"Text {k}" if k % 2 else f"text {k}") for k in range(400)]
    got = merkle_manifest(frame(spark, rows), changed={"text": lower_case_tampered()}).withColumn("folded", fold(F.col("candidate"), F.col("path"))).collect()
    for r in got:
        assert (r.folded == r.root) == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0 or r.doc_id % 2 == 0)
    assert 20 < sum(r.folded != r.root for r in got) < 60


def test_odd_rows(spark):
    long = "Sehr lang " * 200_000
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "a", "x", 0, ""), (5, "a", "x", 0, ""), (5, "a", "x", 0, None), (5, "a", "x", 0, None), (-7, "a", "x", 1, long), (11, "ü", "-", 3, "1:a")]
    got = merkle_manifest(frame(spark, rows), changed={"text": lower_case_tampered()})
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "candidate"]
    assert rows_of(got) == sorted(manifest(rows), key=repr)
    assert merkle_manifest(frame(spark, rows).limit(0)).count() == 0
