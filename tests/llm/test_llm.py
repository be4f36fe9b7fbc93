"""The training-data operators: brute force, round trips, held-out accuracy, and odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlink.llm import queries as Q
from rosterlink.llm.common import labelled_sample, without
from rosterlink.llm.components import connected_components
from rosterlink.llm.decontamination import contaminated
from rosterlink.llm.fingerprint import PrefixHash, fingerprints_with_edits, likeness
from rosterlink.llm import license_scan
from rosterlink.llm.license_scan import license_hits
from rosterlink.llm.ngram_join import ngram_jaccard_components
from rosterlink.llm.packing import WordIds, pack, place_runs, token_pieces
from rosterlink.llm.preferences import format_preferences, other_answer_preferences
from rosterlink.llm.quality import fit_quality, score_quality
from rosterlink.llm.secrets import candidates, fit_secrets, labelled_by_rule, redact, scan_secrets
from rosterlink.llm.toxicity import LOOK_ALIKE, STANDS_FOR, Lexicon, fit_lexicon, fold, score_toxicity, without_toxic
from rosterlink.llm.url_filter import RULES, judge_urls

SMALL, SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
LONG = " ".join(f"wort{k % 977} und{k % 31}" for k in range(60_000))
NAMES = ["node", "n", "token", "h", "key", "x", "id", "value", "rank", "lane", "label", "score", "source"]
TEXTS = [(0, "one two three four five six seven"), (1, "ONE two\tthree four\nfive six seven"), (2, None), (3, ""), (4, "   \n"), (5, "a b"), (6, "A  B"), (7, LONG), (7, LONG), (None, "one two three"), (8, "x\u0001y token = \"ab12cd34ef56ab12cd34\" é🙂"), (9, "🙂" * 10)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, and columns with clashing names."""
    return spark.createDataFrame([(i, t, *(None,) * len(NAMES)) for i, t in TEXTS], "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(400, 700)] + [(k, k + 1) for k in range(2000, 2060)] + [(5, 5), (999, 999), (None, 4)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    up = {x: x for e in edges for x in e if None not in e}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in up}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute(rows, size=5):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_ngram_join_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for base in range(6):
        words = [f"w{rng.randrange(900)}" for _ in range(120)]
        for _ in range(25):  # near copies around the threshold
            copy = list(words)
            for _ in range(rng.randrange(0, 7)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    shared = " ".join(f"s{k}" for k in range(60))
    rows += [(len(rows) + k, f"{shared} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_ngram_join_of_texts_that_share_much_and_never_link(spark):
    """Texts of a few sentences each: every n-gram is in many texts, so the pairs left are verified in blocks."""
    rng = random.Random(8)
    sentences = [" ".join(f"s{k}w{j}" for j in range(12)) for k in range(14)]
    rows = [(k, " ".join(rng.sample(sentences, 6))) for k in range(260)]
    rows += [(500 + k, rows[k][1] + f" tail{k}") for k in range(0, 60, 3)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_ngram_join_odd_rows(spark, odd, empty):
    got = ngram_jaccard_components(odd)
    rows = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and sum(rows.values()) == len(TEXTS)
    assert rows[(0, 3, 0)] == rows[(1, 3, 0)] == rows[(2, 0, 2)] == rows[(3, 0, 3)] == rows[(4, 0, 4)] == rows[(5, 1, 5)] == rows[(6, 1, 5)] == rows[(None, 1, None)] == 1 and sum(v for k, v in rows.items() if k[0] == 7) == 2
    assert ngram_jaccard_components(empty).count() == 0


def test_decontamination(spark, odd, empty):
    item = " ".join(f"frage{k}" for k in range(20))
    swapped = " ".join("anders" if k in (3, 11, 17) else f"Frage{k}," for k in range(20))
    inserted = " ".join(f"frage{k}" + (" neu" if k == 9 else "") for k in range(20))
    docs = spark.createDataFrame([(1, f"vorher {item} nachher"), (2, f"x {swapped} y"), (3, inserted), (4, " ".join(f"frage{k}" for k in range(8))), (5, LONG + " " + item), (6, LONG)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "zu kurz"), (12, None), (10, item), (None, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.matched, r.n_window) for r in contaminated(docs, bench).collect()} == {(1, 10, 20, 20), (2, 10, 17, 20), (3, 10, 20, 20), (5, 10, 20, 20)}
    assert contaminated(odd, bench).count() == 0 and contaminated(empty, bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_looks_around_the_hit(spark, monkeypatch):
    """Long texts of one Zipf vocabulary that share a phrase of seven words hold nothing; a passage of 25 words is found."""
    from rosterlink.llm import decontamination as D

    rng = np.random.default_rng(5)
    draw = lambda n: [f"w{k}" for k in np.minimum(rng.zipf(1.3, n), 5000)]
    phrase = [f"phrase{k}" for k in range(7)]
    texts, items = [draw(150) + phrase + draw(150) for _ in range(5)], [draw(150) + phrase + draw(150) for _ in range(5)]
    frame = lambda rows, name: spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], f"{name} long, text string")
    assert contaminated(frame(texts, "doc_id"), frame(items, "item_id")).isEmpty()
    passages = [draw(300) + items[k][60 + 7 * k : 85 + 7 * k] + draw(200) for k in range(5)] + [items[0]]
    want = {(k, k) for k in range(5)} | {(5, 0)}
    assert {(r.doc_id, r.item_id) for r in contaminated(frame(passages, "doc_id"), frame(items, "item_id")).collect()} == want
    for name in ("BROADCAST_SEEDS", "BROADCAST_WINDOWS", "BROADCAST_IDS"):  # the same by shuffles
        monkeypatch.setattr(D, name, 0)
    assert {(r.doc_id, r.item_id) for r in contaminated(frame(passages, "doc_id"), frame(items, "item_id")).collect()} == want


def test_secrets(spark, odd, empty):
    r = Q.op2_secret_scan(spark, SF).toPandas()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    want = {(i, m.start(1), m[1]) for i, t in docs.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    assert {tuple(x) for x in r[r.secret][["doc_id", "position", "value"]].itertuples(index=False)} == want and (~r.secret).any()
    assert all(docs[d][p : p + len(v)] == v for d, p, v in r[["doc_id", "position", "value"]].itertuples(index=False))
    found = scan_secrets(odd)
    assert [(x.doc_id, x.value, x.secret) for x in found.collect()] == [(8, "ab12cd34ef56ab12cd34", True)]
    masked = redact(odd, found)
    assert masked.columns == odd.columns and masked.count() == len(TEXTS) and masked.where("doc_id = 8").first().text == 'x y token = "[REDACTED]" é🙂'
    assert scan_secrets(empty).count() == 0 and redact(empty, found).count() == 0
    assert labelled_by_rule(candidates(odd)).count() == 1


def findings(rng, n):
    """Labelled findings: keys, tokens and passwords, and what looks like them: ids, hashes, dates, addresses, placeholders."""
    chars = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    letters = "abcdefghijklmnopqrstuvwxyz"
    mixed, hexes, words = letters + letters.upper() + "0123456789", "0123456789abcdef", ["release", "report", "window", "summary", "yellow", "orange", "process", "garden", "number", "planet"]
    word = lambda: rng.choice(words)
    true = [
        lambda: (chars(mixed, rng.randrange(20, 44)), f"{rng.choice(['api_key', 'token', 'client secret'])} = '", "'", "src/app.py"), lambda: (chars(hexes, 40), "export TOKEN=", "\nrun it", "deploy/.env"),
        lambda: (chars(mixed, rng.randrange(10, 16)), "password: ", " # login", "conf/site.yml"), lambda: (chars(letters + letters.upper(), 14), "passwd='", "',", "conf/db.yml"), lambda: ("sk-" + chars(mixed, 30), "the key is ", ". It", "notes/a.txt"),
    ]
    false = [
        lambda: (f"{word()}-{word()}-{rng.randrange(10**6)}", "see page ", " for more", "docs/a.md"), lambda: (f"{word()}.{word()}{rng.randrange(99)}@mail.example.org", "write to ", " today", "docs/team.md"),
        lambda: (f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}T10:00", "date: ", " utc", "log/run.log"), lambda: (chars(hexes, 40), "commit ", " by", "CHANGES.md"), lambda: (f"your_{word()}_token_here1", "token = '", "'", "docs/setup.md"),
    ]
    return [(k, p, v, b, a, 0, float(y)) for k, (y, (v, b, a, p)) in enumerate((y, rng.choice((false, true)[y])()) for y in (rng.randrange(2) for _ in range(n)))]


def test_forest_on_held_out_findings(spark):
    schema = "id long, path string, value string, before string, after string, position long, label double"
    words = ["release", "report", "window", "summary", "yellow", "orange", "process", "garden", "your", "token", "here", "mail", "example"]
    model = fit_secrets(spark.createDataFrame(findings(random.Random(1), 600), schema), words)
    got = model.score(spark.createDataFrame(findings(random.Random(2), 400), schema)).collect()
    hits = sum(r.secret and r.label == 1 for r in got)
    assert hits / sum(r.secret for r in got) >= 0.95 and hits / sum(r.label == 1 for r in got) >= 0.95


def test_secrets_of_a_long_text_take_linear_time(spark):
    import time

    text = lambda n: "\n".join(f'token = "{hashlib.sha1(str(k).encode()).hexdigest()}"' for k in range(n))
    took = []
    for n in (2_000, 16_000):
        began = time.time()
        got = candidates(spark.createDataFrame([(1, text(n))], "doc_id long, text string"), path_col=None)
        row = got.agg(F.count("*"), F.max("position")).first()
        took.append(time.time() - began)
        assert row[0] == n and row[1] == len(text(n)) - 41
    assert took[1] < 8 * took[0] + 5


def test_redaction_by_row(spark):
    secret = lambda c: c * 5 + "1" + c * 20
    docs = spark.createDataFrame([(1, f'token = "{secret("a")}" x'), (1, f'x token = "{secret("b")}" and token = "{secret("a")}"'), (None, f'token = "{secret("c")}"'), (2, None)], "doc_id long, text string")
    found = scan_secrets(docs, path_col=None)
    assert sorted(r.text or "" for r in redact(docs, found).collect()) == ["", 'token = "[REDACTED]"', 'token = "[REDACTED]" x', 'x token = "[REDACTED]" and token = "[REDACTED]"']


def test_secrets_are_cut_out_of_their_surroundings(spark):
    BLOCK = "-----BEGIN RSA PRIVATE KEY-----\nMIIEow+/\nAbCd==\n-----END RSA PRIVATE KEY-----"
    gh, aws = "ghp_" + "a1B2c3D4e5" * 4, "AKIA" + "ABCD1234EFGH5678"
    texts = {
        f"GITHUB_TOKEN={gh}": [gh], f"AWS_KEY={aws}": [aws], f"GET /x?token={gh}&page=2": [gh], f"The key is {aws}. It": [aws], f"see https://host.org/files/{aws}": [aws],
        "postgres://user:pass1234word@db.host.com/x": ["pass1234word"], "redis://:geheim@cache": ["geheim"], "user:pass1234word@db.host.com": ["pass1234word"],
        "password: hunter2": ["hunter2"], '{"password": "open sesame"}': ["open sesame"], "DB2_MASTER_PASSWORD=hunter2\n": ["hunter2"], "Authorization: Bearer abc123": ["abc123"],
        "mailto:john12345678@host.com": ["john12345678@host.com"], "YWJjZGVmZ2hpamtsbW5vcA12== end": ["YWJjZGVmZ2hpamtsbW5vcA12=="], f'key = """{BLOCK}"""': [BLOCK], "no secret here": [],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = candidates(docs, path_col=None)
    got, rows = collections.defaultdict(list), found.collect()
    for r in rows:
        got[list(texts)[r.id]].append(r.value)
        assert list(texts)[r.id][r.position : r.position + len(r.value)] == r.value
    assert {t: [v for v in got[t] if v in want or not want] for t, want in texts.items()} == texts and all("=" not in v.rstrip("=") for vs in got.values() for v in vs if v != BLOCK)
    label = {(r.id, r.value): r.label for r in labelled_by_rule(found).collect()}
    assert [label.get((k, w[0])) for k, (t, w) in enumerate(texts.items()) if w] == [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, None, None, None, 1.0, None, 0.0, None, 1.0]
    long = "token=" + "." * 30_000 + " 1" + "." * 30_000 + " " + "a1." * 20_000 + " x:" + "a" * 30_000 + " " + "eyJ-" * 2_000
    assert candidates(spark.createDataFrame([(1, long)], "doc_id long, text string"), path_col=None).count() >= 1


def test_secrets_with_labels_of_one_class(spark):
    frame = lambda *texts: spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, source string")
    clean = frame("write to john12345678@host.com", "on 2024-01-01/2024-12-31", "see https://host.org/a/page1234567")
    assert clean.count() == 3 and scan_secrets(clean).where("secret").isEmpty() and scan_secrets(clean).count() >= 3
    assert [r.text for r in redact(clean, scan_secrets(clean)).orderBy("doc_id").collect()] == [r.text for r in clean.orderBy("doc_id").collect()]
    only = frame('token = "ab12cd34ef56ab12cd34"', "see page/chapter1234567", "password: swordfish")
    assert sorted(r.value for r in scan_secrets(only).where("secret").collect()) == ["ab12cd34ef56ab12cd34", "swordfish"]


def auc(score, label):
    pos, neg = np.sort(score[label == 1]), np.sort(score[label == 0])
    return np.mean((np.searchsorted(neg, pos) + np.searchsorted(neg, pos, "right")) / 2) / len(neg)


@pytest.mark.parametrize("name, label, least", [("op3_toxicity", "toxic", 0.93), ("op5_quality", "quality", 0.98)])
def test_held_out_accuracy(spark, name, label, least):
    r = Q.QUERIES[name](spark, LARGER)
    assert r.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count() and r.where("score < 0 or score > 1 or score is null").isEmpty()
    x = r.where("held_out").join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").toPandas()
    assert auc(x.score, x[label]) >= least


def test_toxicity(spark, odd, empty):
    assert fold("1d10t Id!ot сlоwn!! $$$ Größe") == " idiot idiot ciown größe ".replace("ö", "o")
    lexicon = Lexicon({" idiot ": 4.0, " achiich": 3.0}, [" achiich ", " idiot box "], (3.0, 0.0, -2.0))
    docs = spark.createDataFrame([(1, "you 1DI0T"), (2, "achlich"), (3, "achlichkeit"), (4, "idiot box"), (5, "idiotic idiot box idiot")], "doc_id long, text string")
    assert {r.doc_id: r.toxic_weight for r in score_toxicity(docs, lexicon).collect()} == {1: 4.0, 2: 0.0, 3: 3.0, 4: 0.0, 5: 4.0}
    assert score_toxicity(odd, lexicon).count() == len(TEXTS) and score_toxicity(empty, lexicon).count() == 0 and score_toxicity(odd, Lexicon({})).where("toxic_weight > 0").isEmpty()
    assert sorted(r.doc_id for r in without_toxic(docs, lexicon).collect()) == [2, 4] and without_toxic(odd, lexicon).columns == odd.columns
    none = fit_lexicon(labelled_sample(empty.select("doc_id", "text"), empty.select("doc_id", F.lit(1).alias("label"))))
    assert none.weights == {}


def plain_fold(text):
    """Folding, character by character."""
    import unicodedata

    text, out = text.lower(), []
    for i, c in enumerate(text):
        if c in "@$!|€£":
            a = i
            while a and text[a - 1] in "@$!|€£":
                a -= 1
            z = i
            while z + 1 < len(text) and text[z + 1] in "@$!|€£":
                z += 1
            inside = 0 < a and z + 1 < len(text) and all(x.isalnum() for x in (text[a - 1], text[z + 1]))
            out.append(STANDS_FOR[c] if inside else " ")
        else:
            out.append(c)
    text = "".join(out)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower()
    out = []
    for c in text:
        if unicodedata.category(c) not in ("Mn", "Cf"):
            c = LOOK_ALIKE.get(c, c)
            c = " " if c in "@$!|€£" else STANDS_FOR.get(c, c)
            out.append(c if c.isalnum() else " ")
    return " " + " ".join("".join(out).split()) + " "


def plain_weight(text, lexicon):
    """Every entry looked for at every place; an entry within an exception phrase doesn't count."""
    spots = lambda e: [i for i in range(len(text)) if text.startswith(e, i)]
    safe = [(i, i + len(e)) for e in lexicon.exceptions for i in spots(e)]
    best = {}
    for e, w in lexicon.weights.items():
        for i in spots(e):
            end = i + len(e) - e.endswith(" ")
            if not any(a <= i and end <= z for a, z in safe):
                best[i] = max(best.get(i, 0.0), w)
    return sum(best.values())


def test_toxicity_matches_a_plain_search(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lexicon = fit_lexicon(Q._teaching(spark, SF, "toxic", 3, 1))
    a, b, c = lexicon.calibration
    got = {r.doc_id: r for r in score_toxicity(docs, lexicon).collect()}
    assert len(lexicon.weights) > 5 and any(r.toxic_weight > 0 for r in got.values())
    for r in docs.select("doc_id", "text").collect():
        text = plain_fold(r.text or "")
        x, n = plain_weight(text, lexicon), len(text.split())
        score = 1 / (1 + np.exp(-(np.log1p(x) * a + x / np.sqrt(n + 1) * b + c)))
        assert got[r.doc_id].toxic_weight == pytest.approx(x) and got[r.doc_id].score == pytest.approx(score) and got[r.doc_id].predicted == (score >= 0.7)


def test_quality_matches_single_compressions(spark):
    import zstandard

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = fit_quality(Q._teaching(spark, SF, "quality", 5, 0))
    size = []
    for d in (model.bad, model.good):
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False)
        size.append(lambda t, squeeze=squeeze: sum(len(squeeze.compress(t[k : k + 1024])) for k in range(0, len(t), 1024)))
    got = {r.doc_id: r for r in score_quality(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        raw = (r.text or "").encode()
        score = 1 / (1 + np.exp(-((size[0](raw) - size[1](raw)) / max(1, len(raw)) * model.weights[0] + model.weights[1])))
        assert got[r.doc_id].score == pytest.approx(score) and got[r.doc_id].predicted == (score >= 0.3)


def test_quality_odd_rows(spark, odd, empty):
    labels = odd.select("doc_id", (F.col("doc_id") % 2).alias("label"))
    model = fit_quality(labelled_sample(odd.select("doc_id", "text"), labels))
    got = score_quality(odd, model)
    assert got.count() == len(TEXTS) and got.where("score is null").isEmpty() and score_quality(empty, model).count() == 0
    assert fit_quality(labelled_sample(empty.select("doc_id", "text"), labels)).weights is not None


def check_packing(rows, most):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= most
    return len(by)


def best_fit_decreasing(counts, most):
    gaps = []
    for n in sorted(counts.elements(), reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(most - n)
    return len(gaps)


@pytest.mark.parametrize("kind", ["mixed", "two sizes", "one size"])
def test_rounds_place_every_piece_as_well_as_best_fit_decreasing(spark, kind):
    rng = random.Random(2)
    counts = {
        "mixed": collections.Counter(rng.choice([rng.randrange(1, 101), rng.randrange(1, 12), 100]) for _ in range(600)),
        "two sizes": collections.Counter({55: 200, 2: 3000}), "one size": collections.Counter({7: 500}),
    }[kind]
    runs = place_runs(spark.createDataFrame(list(counts.items()), "length long, n long"), 100).collect()
    ranks, parts = collections.defaultdict(list), collections.defaultdict(list)
    for size, first, n, seq, at, copies in runs:
        ranks[size] += range(first, first + n)
        for i in range(n):
            parts[seq + i // copies].append((at + i % copies * size, size))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for p in parts.values():
        ends = 0
        for at, size in sorted(p):
            assert at == ends
            ends += size
        assert ends <= 100
    assert len(parts) <= best_fit_decreasing(counts, 100) * 1.02 + 1


def test_packing(spark, odd, empty):
    rows = pack(token_pieces(odd, Q.vocabulary())).collect()
    check_packing(rows, 2048)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.vocabulary())
    texts = [x or "" for _, x in TEXTS] + ["<|endoftext|> don't I'LL É ΑΣ ΣΑΣ İx 12a🙂b c d\x1ce", "é ½ ﬁ Ǆ ſ"]
    for x in texts:
        assert np.frombuffer(WordIds(Q.vocabulary()).ids(x), np.uint32).tolist() == t.encode(x, add_special_tokens=False).ids
    want = collections.Counter()
    for i, x in TEXTS:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert pack(token_pieces(empty, Q.vocabulary())).count() == 0
    got = Q.op4_best_fit_packing(spark, SF).collect()
    assert check_packing(got, 2048) <= -(-sum(r.length for r in got) // 2048) * 1.01 + 1


def test_url_filter(spark):
    link = '<link href="{}" rel=canonical>'
    pages = [(1, "http://a.example.com/en/817", ""), (2, "https://x.other/p?q=1#f", '<link rel="canonical" href="http://A.example.com/en/817">'), (3, "http://a.example.com/en/7", link.format("/en/817")), (4, None, None), (5, "nothing", ""), (6, "http://far.away", '<meta http-equiv="refresh" content="0; url=//x.other/p?q=1">'), (7, "http://clean.site/", ""), (8, "HTTP://B.EXAMPLE.NET/de/8", ""), (9, "http://notexample.net/de/8x", ""), (2, "https://x.other/p?q=1#f", "")]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, RULES).collect()}
    assert got == {
        1: ("a.example.com", "/en/817", "com/en/", "block"), 2: ("x.other", "/p", None, "block"), 3: ("a.example.com", "/en/7", "example.com/en/7", "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
        6: ("far.away", "", None, "block"), 7: ("clean.site", "/", None, "allow"), 8: ("b.example.net", "/de/8", "example.net/de/8", "block"), 9: ("notexample.net", "/de/8x", "net/de/", "allow"),
    }
    assert judge_urls(df, RULES).count() == len(pages) and judge_urls(df.limit(0), RULES).count() == 0
    moved = spark.createDataFrame([("http://clean.site/", "http://evil.com/en/1")], "src string, dst string")
    assert judge_urls(df.where("page_id = 7"), RULES, moved).first().verdict == "block"


def test_url_aliases_match_a_plain_search(spark):
    """Chains, rings, hubs and random links, absolute and relative, against a search over the links."""
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(0, 60)] + [(k, 100 + (k + 1 - 100) % 30) for k in range(100, 130)] + [(k, 200) for k in range(201, 300)] + [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(70)]
    bad, fine = {7, 120, 250, *range(400, 600, 37)}, {30, 210}
    host = lambda k: "blocked.net" if k in bad else "fine.net" if k in fine else "h.org"
    out = collections.defaultdict(list)
    for a, b in links:
        out[a].append(b)
    shapes = ['<link rel="canonical" href="{}">', "<link href={} rel=canonical>", '<meta http-equiv="refresh" content="0; url={}">', '<meta content="1;url={}" http-equiv="Refresh">']
    pages = []
    for k in range(600):
        html = "<!-- <link rel=canonical href=http://blocked.net/p/7> --><script>'<link rel=canonical href=http://blocked.net/p/7>'</script>"
        for b in out[k]:
            to = f"http://{host(b)}/p/{b}?a=1&amp;b=2" if host(b) != host(k) or rng.random() < 0.5 else rng.choice([f"/p/{b}?a=1&amp;b=2", f"{b}?a=1&#38;b=2", f"//{host(b)}/p/{b}?a=1&amp;b=2"])
            html += rng.choice(shapes).format(to)
        pages.append((k, f"http://{host(k)}/p/{k}?a=1&b=2", html + "x" * (2_000_000 if k == 3 else 0)))
    component = {k: {k} for k in range(600)}
    for a, b in links:
        if component[a] is not component[b]:
            both = component[a] | component[b]
            for k in both:
                component[k] = both
    rules = [("block", "blocked.net", "/p"), ("allow", "fine.net", "/")]
    got = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    assert got == {k: "allow" if k in fine else "block" if component[k] & bad else "allow" for k in range(600)}


def test_fingerprints(spark, odd, empty):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice("abc dé🙂") for _ in range(rng.randrange(0, 60)))) for k in range(0, 80, 2)] + [(3, None), (5, ""), (9, LONG)]
    got = {r.doc_id: r for r in fingerprints_with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        e = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        f, g, h = (PrefixHash(x).fingerprint() for x in (t, e, nxt))
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, likeness(f, g), likeness(f, h))
        common = next((q for q in range(min(len(t), len(e))) if t[q] != e[q]), min(len(t), len(e)))
        assert r.common_prefix == common
    a, b = PrefixHash("xxabcabcdyy"), PrefixHash("abcabcz")
    assert a.equal(2, 0, 6, b) and not a.equal(2, 0, 7, b) and a.common_extension(2, 0, b) == 6 and a.common_extension(2, 5) == 3 and not a.equal(8, 0, 7, b)
    assert fingerprints_with_edits(odd).count() == len(TEXTS) and fingerprints_with_edits(empty).count() == 0
    one = fingerprints_with_edits(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0


def plain_fingerprint(text):
    """The smallest mixed window hashes, each window's polynomial worked out by itself."""
    primes, bases, mask = (2147483647, 2147483629), (911382323, 972663749), 2**64 - 1
    w, found = min(12, len(text)), set()
    for i in range(len(text) - w + 1) if text else ():
        h = 0
        for p, b in zip(primes, bases):
            h = h << 31 | sum((ord(c) + 1) * pow(b, k, p) for k, c in enumerate(text[i : i + w])) % p
        h = h * 0x9E3779B97F4A7C15 & mask
        found.add(((h ^ h >> 32) * 0xD6E8FEB86659FD93 & mask) >> 32)
    return "".join(f"{x:08x}" for x in sorted(found)[:64])


def test_fingerprints_match_single_windows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars < 1500")
    rows = {r.doc_id: r for r in fingerprints_with_edits(docs).collect()}
    texts = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    for k, (i, t) in enumerate(texts[:40]):
        nxt = texts[k + 1][1]
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        f, e, n = plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(nxt)
        parts = lambda x: [x[j : j + 8] for j in range(0, len(x), 8)]
        alike = lambda x, y: np.mean([h in parts(x) and h in parts(y) for h in sorted({*parts(x), *parts(y)})[:64]]) if x or y else 1.0
        r = rows[i]
        assert (r.fingerprint, r.edited_fingerprint) == (f, e) and r.near_edited == pytest.approx(alike(f, e)) and r.near_next == pytest.approx(alike(f, n))


def test_licenses(spark, odd, empty):
    docs = spark.createDataFrame([(1, "Copyright (c) 2020 A\nreleased UNDER the  MIT licence!"), (2, "text\n\n * Licensed under CC BY-NC 4.0\nmore"), (3, "we like the MIT license"), (1, "x\nReleased under the MIT License."), (4, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.unit, r.position, r.license) for r in license_hits(docs).collect()) == [(1, "document", 0, "MIT"), (1, "line", 1, "MIT"), (1, "line", 1, "MIT"), (2, "line", 2, "CC-BY-NC-4.0")]
    assert license_hits(odd).count() == 0 and license_hits(empty).count() == 0


def test_licenses_beside_other_text(spark):
    bsd = max((t for k, t in license_scan.ALL_KNOWN if k == "BSD-2-Clause"), key=len)
    mit = next(t for k, t in license_scan.KNOWN if k == "MIT")
    wrapped = re.sub(r"(.{50,60}) ", r"\1\n# ", mit)
    docs = [
        (1, "Copyright (c) 2020 A B. Released under the MIT License."), (2, f"int x;\n# {wrapped}\nint y;"), (3, f"{LONG}\n\n{bsd}\n\n{LONG}"), (4, "line\n" * 50_000 + "Licensed under CC0 1.0.\n" + "line\n" * 50_000),
        (None, "Licensed under CC BY 4.0."), (None, "Licensed under CC BY 4.0."), (5, "permission license merchantability"), (6, "a\n\n\n\nLicensed under CC BY 4.0.\n\n"),
    ]
    got = sorted((r.doc_id or 0, r.unit, r.position, r.license) for r in license_hits(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == [(0, "document", 0, "CC-BY-4.0")] * 2 + [(1, "document", 0, "MIT"), (2, "lines", 1, "MIT"), (3, "line", 2, "BSD-2-Clause"), (3, "paragraph", 1, "BSD-2-Clause"), (4, "line", 50_000, "CC0-1.0"), (6, "line", 4, "CC-BY-4.0"), (6, "paragraph", 2, "CC-BY-4.0")]
    own = [("House", "All rights stay here"), ("House", "Nobody may copy\nthis")]
    assert [(r.unit, r.license) for r in license_hits(spark.createDataFrame([(1, "x\nNobody may copy\nthis.\ny")], "doc_id long, text string"), own).collect()] == [("lines", "House")]


def test_licenses_wrapped_and_within_documents(spark):
    import textwrap

    from rosterlink.llm.license_scan import ALL_KNOWN, KNOWN

    gpl = max((t for k, t in ALL_KNOWN if k == "GPL-3.0"), key=len)
    text = {k: t for k, t in reversed(KNOWN) if len(t) > 400}
    mit = "\n\n".join(textwrap.fill(p, 60) for p in re.split(r"(?<=conditions:) |(?<=Portions of the Software\.) ", text["MIT"]))
    isc = text["ISC"].replace("copyright notice and this permission", "\ncopyright notice and this permission").replace("copies. THE", "copies.\n\nTHE")
    holders = text["MIT"].replace("COPYRIGHT HOLDERS", "\n * COPYRIGHT\n * HOLDERS")
    docs = [(1, isc), (2, text["MIT"].replace("OR COPYRIGHT", "OR\nCOPYRIGHT")), (3, holders), (4, f"My tool\n\nMIT License\n\nCopyright (c) 2020 A\n\n{mit}\n\nThanks"), (5, f"MIT License\n{text['MIT']}"), (6, mit[:-10]), (7, f"Copyright The Authors\n{mit}"), (8, f"{mit}\n\n{mit}"), (9, gpl)]
    got = sorted((r.doc_id, r.unit, r.position, r.license) for r in license_hits(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.unit != "line")
    n = len(mit.split("\n\n"))
    assert got == [(1, "document", 0, "ISC"), (2, "document", 0, "MIT"), (3, "document", 0, "MIT"), (4, "paragraphs", 1, "MIT"), (4, "paragraphs", 3, "MIT"), (5, "document", 0, "MIT"), (7, "document", 0, "MIT"), (8, "paragraphs", 0, "MIT"), (8, "paragraphs", n, "MIT"), (9, "document", 0, "GPL-3.0"), (9, "paragraph", 113, "GPL-3.0")]


def test_preferences(spark):
    t = "pair_id long, turn long, role string, text string, side string"
    c = [(1, 0, "user", "hi"), (1, 1, "assistant", "A"), (1, 2, "user", "u"), (2, 0, "user", "q"), (2, 1, "assistant", None), (3, 0, "user", "only"), (None, 0, "user", "x"), (4, 1, "assistant", "b"), (4, 0, "user", "a"), (5, 0, "user", "p")]
    r = [(1, 0, "user", "hi"), (1, 1, "assistant", "B"), (2, 0, "user", "q"), (2, 1, "assistant", ""), (4, 0, "user", "z"), (4, 1, "assistant", "b"), (5, 0, "assistant", "p")]
    frame = lambda rows: spark.createDataFrame([(*x, "s") for x in rows], t)
    got = {x.pair_id: x for x in format_preferences(frame(c), frame(r)).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and [got[k].n_prompt_turns for k in range(1, 6)] == [1, 2, 0, 0, 0]
    one = got[1]
    assert one.prompt == "<|im_start|>user\nhi<|im_end|>\n" and one.chosen.startswith("<|im_start|>assistant\nA") and one.rejected == "<|im_start|>assistant\nB<|im_end|>\n"
    a, b = map(int, one.chosen_mask.split("-"))
    assert one.chosen[a:b] == "A<|im_end|>\n" and got[2].chosen == got[2].rejected == "" and got[3].rejected == "" and got[3].chosen_mask == ""
    assert format_preferences(frame(c).limit(0), frame(r).limit(0)).count() == 0


def test_sql_queries(spark):
    import sys

    sys.path.insert(0, "tests")
    from oracle import compare

    for name in ("op1_decontamination", "op6_url_filter", "op8_license_scan", "op9_ngram_jaccard", "op10_preference_format"):
        compare(spark, "/root/testdata/sf0.001", Q.QUERIES[name], Q.ORACLE[name])


def test_pipeline(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [k for k, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and stage(spark, docs.limit(0), sf).count() == 0
    got = {r.doc_id for r in P.near_duplicates(spark, docs, sf).collect()}
    assert got == {i for i, (_, c) in brute([tuple(r) for r in docs.select("doc_id", "text").collect()]).items() if c == i}
    held = {r.doc_id for r in contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in P.decontamination(spark, docs, sf).collect()} == {r.doc_id for r in docs.collect()} - held
    masked = P.secrets(spark, docs, sf)
    assert masked.count() == docs.count() and masked.where(F.col("text").rlike('token = "[0-9a-f]{40}"')).isEmpty() and masked.where("n_chars <> length(text)").isEmpty()
    check_packing(P.run(spark, sf).collect(), 2048)
    assert without(docs, docs.select("doc_id").limit(0)).count() == docs.count()


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    import corpus_pipeline as P

    item, a, b = (" ".join(f"{w}{k}" for k in range(30)) for w in ("frage", "alpha", "beta"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = lambda rows: spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    kept = lambda df: sorted((r.doc_id or 0, (r.text or "")[:4]) for r in df.collect())
    docs = frame([(None, f"x {item} y"), (None, a), (5, item), (5, b), (6, None)])
    assert kept(P.decontamination(spark, docs, str(tmp_path))) == [(0, "alph"), (5, "beta"), (6, "")]
    docs = frame([(None, a), (None, a), (3, a), (4, b), (4, b), (7, a), (7, item), (8, None), (None, None)])
    out = P.near_duplicates(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and kept(out) == [(0, ""), (3, "alph"), (4, "beta"), (7, "frag"), (8, "")]


def test_other_answer_preferences(spark):
    rows = [
        (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (2, 0, "user", "q2"), (5, 0, "user", "q5"), (5, 1, "assistant", "a5"), (5, 2, "user", "u"), (5, 3, "assistant", "b5"), (5, 4, "user", "thanks"),
        (90, 0, "user", "q90"), (90, 1, "assistant", "a1"), (91, 0, "user", None), (91, 1, "assistant", "tie b"), (91, 1, "assistant", "tie a"), (91, 1, "assistant", "tie a"), (None, 0, "assistant", "lost"), (92, 0, "assistant", "x" * 300_000),
    ]
    turns = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, pair string")
    got = {r.conv_id: r for r in other_answer_preferences(turns).collect()}
    said = lambda *ts: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in ts)
    branch = {1: "a1", 5: "b5", 90: "a1", 91: "tie a", 92: "x" * 300_000}
    ring = sorted(set(branch.values()), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    other = {k: said(("assistant", ring[(ring.index(t) + 1) % len(ring)])) for k, t in branch.items()}
    assert set(got) == {1, 2, 5, 90, 91, 92} and {k: got[k].rejected for k in branch} == other
    assert (got[5].prompt, got[5].chosen, got[5].n_prompt_turns) == (said(("user", "q5"), ("assistant", "a5"), ("user", "u")), said(("assistant", "b5"), ("user", "thanks")), 3)
    a, b = map(int, got[5].chosen_mask.split("-"))
    assert got[5].chosen[a:b] == "b5<|im_end|>\n" and got[1].paired and got[90].rejected == got[1].rejected
    assert (got[91].n_prompt_turns, got[91].chosen) == (2, said(("assistant", "tie a"), ("assistant", "tie b"))) and len(got[91].chosen_mask.split(",")) == 2
    assert (got[2].prompt, got[2].chosen, got[2].rejected, got[2].paired) == (said(("user", "q2")), "", "", False)
    alone = other_answer_preferences(turns.where("conv_id = 1")).first()
    assert not alone.paired and alone.n_prompt_turns == 2 and other_answer_preferences(turns.limit(0)).count() == 0


def test_preference_query_keeps_every_conversation(spark):
    r = Q.op10_preference_format(spark, SF).toPandas()
    turns = spark.read.parquet(f"{SF}/conversations.parquet").toPandas()
    assert len(r) == turns.conv_id.nunique()
    has = set(turns[turns.role == "assistant"].conv_id)
    assert set(r[r.paired].conv_id) == has and (r[r.paired].rejected != r[r.paired].chosen).all()
    assert (r.prompt.str.count("<.im_start.>") + r.chosen.str.count("<.im_start.>")).sum() == len(turns) and (r[r.paired].n_prompt_turns < turns.groupby("conv_id").size().reindex(r[r.paired].conv_id).to_numpy() - 1).any()


def test_rows_without_an_id_can_go(spark, odd):
    assert without(odd, odd.where("doc_id is null")).where("doc_id is null").isEmpty() and without(odd, odd.where("doc_id = 7")).count() == len(TEXTS) - 2


def test_batches_of_texts_are_bounded(spark):
    from rosterlink.llm.common import BATCH_BYTES, text_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    text_batches(spark)
    assert spark.conf.get(key) == str(BATCH_BYTES)
    spark.conf.set(key, "4m")
    text_batches(spark)
    assert spark.conf.get(key) == "4m"
    spark.conf.unset(key)
