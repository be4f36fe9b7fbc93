"""The registered queries ``opN_<name>``: thin, each over its whole table, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlink.llm.bottom_k import near_duplicates
from rosterlink.llm.common import held_out, labelled_sample, table
from rosterlink.llm.decontamination import MASKS, contaminated
from rosterlink.llm.fingerprint import fingerprints_with_edits
from rosterlink.llm.lexical_search import search
from rosterlink.llm.license_scan import COPYRIGHT_LINE, KNOWN, SPELLINGS, license_hits
from rosterlink.llm.merkle import FAN, LEAF, LOWER, UPPER, fold, lower_case_tampered, merkle_manifest
from rosterlink.llm.ngram_join import ngram_jaccard_components
from rosterlink.llm.packing import pack, token_pieces
from rosterlink.llm.preferences import BEGIN, BREAK, END, other_answer_preferences
from rosterlink.llm.quality import fit_quality, score_quality
from rosterlink.llm.secrets import scan_secrets
from rosterlink.llm.toxicity import fit_lexicon, score_toxicity
from rosterlink.llm.url_filter import AMPERSANDS, HIDDEN, PATTERNS, RULES, judge_urls

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and its component."""
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


_LINKED_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i+{last}], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {last}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id{more}
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""
ORACLE["op9_ngram_jaccard"] = _LINKED_SQL.format(last=4, more="")


@query
def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set of four-word shingles, its component and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)


ORACLE["op12_minhash_dedup"] = _LINKED_SQL.format(last=3, more=", d.doc_id = c.component_id AS kept")


def _teaching(spark: SparkSession, sf_dir: str, label: str, modulus: int, remainder: int) -> DataFrame:
    """A bounded sample of the labelled documents that may teach."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", modulus, remainder))
    return labelled_sample(table(spark, sf_dir, "documents"), labels, label_col=label)


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; taught by labelled rows outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(_teaching(spark, sf_dir, "quality", 5, 0))
    return score_quality(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; taught by labelled rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    lexicon = fit_lexicon(_teaching(spark, sf_dir, "toxic", 3, 1))
    scored = score_toxicity(docs, lexicon)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted", "toxic_weight")


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; ``common_prefix`` is what both share from the start."""
    return fingerprints_with_edits(table(spark, sf_dir, "documents"))


def vocabulary() -> str:
    """The vocabulary file of the packing query."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(token_pieces(table(spark, sf_dir, "documents"), vocabulary()))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its rule and verdict; ``component_blocked``: an alias is blocked."""
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


_HOST = "translate(coalesce(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
_QUERY = "coalesce(regexp_extract({0}, '(?s)^[^#]*?([?][^#]*)', 1), '')"
_KEY = f"CASE WHEN {_HOST} <> '' THEN {_HOST} || {_PATH} || {_QUERY} END"
_FOUND = ", ".join("regexp_extract_all(h, '" + p.replace("'", "''") + "', 1)" for p in PATTERNS)
_SPELLED = functools.reduce(lambda out, a: f"replace({out}, '{a}', '&')", AMPERSANDS, "t")
_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
ORACLE["op6_url_filter"] = rf"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES {_RULES_SQL}),
pg AS MATERIALIZED (SELECT page_id, url, html, {_HOST.format('url')} AS host, {_PATH.format('url')} AS path, {_KEY.format('url')} AS k FROM pages),
hit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM pg JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
declared AS (SELECT url AS src, unnest(regexp_extract_all(html, '(?is)<link[^>]*rel\s*=\s*["'']?canonical[^>]*href\s*=\s*["'']?([^"''\s>]+)', 1)) AS dst FROM pages),
e AS MATERIALIZED (SELECT {_KEY.format('src')} AS a, {_KEY.format('dst')} AS b FROM declared WHERE dst LIKE '%://%'),
both_ways AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT k, k AS r FROM (SELECT DISTINCT k FROM pg JOIN both_ways ON k = a) UNION SELECT reach.k, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
bad AS (SELECT DISTINCT reach.k FROM reach JOIN pg ON pg.k = reach.r JOIN hit USING (page_id) WHERE hit.verdict = 'block')
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, CASE WHEN bad.k IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, bad.k IS NOT NULL AS component_blocked
FROM pg LEFT JOIN hit USING (page_id) LEFT JOIN bad ON bad.k = pg.k
"""


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, paragraph, run of either and document that is a known licence text."""
    return license_hits(table(spark, sf_dir, "documents"))


def _canonical_sql(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim(regexp_replace(regexp_replace({out}, '{COPYRIGHT_LINE}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".replace("\\\\", "\\")


_KNOWN_SQL = ", ".join("('" + k + "', '" + t.replace("'", "''") + "')" for k, t in sorted(set(KNOWN)))
ORACLE["op8_license_scan"] = f"""
WITH known(license, t) AS (VALUES {_KNOWN_SQL}),
digests AS (SELECT min(license) AS license, {_canonical_sql('t')} AS c FROM known GROUP BY 2),
units AS (
  SELECT doc_id, 'document' AS unit, 0 AS position, coalesce(text, '') AS part FROM documents
  UNION ALL SELECT doc_id, 'paragraph', unnest(range(len(p))), unnest(p) FROM (SELECT doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM documents) WHERE len(p) > 1
  UNION ALL SELECT doc_id, 'line', unnest(range(len(p))), unnest(p) FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents) WHERE len(p) > 1)
SELECT doc_id, unit, CAST(position AS INTEGER) AS position, license
FROM (SELECT doc_id, unit, position, {_canonical_sql('part')} AS c FROM units) JOIN digests USING (c) WHERE c <> ''
"""


@query
def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation: chosen as it is, rejected with another conversation's answer in the place of one of its own."""
    return other_answer_preferences(table(spark, sf_dir, "conversations"))


def _turn_sql(role: str, text: str) -> str:
    q = lambda x: "'" + x.replace("\n", "' || chr(10) || '") + "'"
    return f"({q(BEGIN)} || {role} || {q(BREAK)} || {text} || {q(END)})"


_HEAD = len(BEGIN) + len(BREAK)
ORACLE["op10_preference_format"] = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM t WHERE role = 'assistant'),
branch AS (SELECT conv_id, i AS place, text AS said, sha256(text) AS h FROM a WHERE k = conv_id % n),
ring AS (SELECT h, said, coalesce(lead(h) OVER (ORDER BY h), min(h) OVER ()) AS after FROM (SELECT h, any_value(said) AS said FROM branch GROUP BY h)),
other AS (SELECT x.h, y.said AS other FROM ring x JOIN ring y ON y.h = x.after),
p AS (SELECT c.conv_id, place, said, other, (SELECT max(i) FROM t WHERE t.conv_id = c.conv_id) AS n FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN branch USING (conv_id) LEFT JOIN other USING (h)),
cut AS (SELECT *, CASE WHEN place IS NULL THEN n WHEN said = other THEN place ELSE place - 1 END AS k FROM p),
r AS (SELECT t.conv_id, i, k, {_turn_sql('role', 'text')} AS x, role, {_HEAD} + length(role) AS head FROM t JOIN cut USING (conv_id)),
s AS (SELECT *, sum(CASE WHEN i > k THEN length(x) ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM r),
g AS (SELECT conv_id, coalesce(string_agg(x, '' ORDER BY i) FILTER (i <= k), '') AS prompt, coalesce(string_agg(x, '' ORDER BY i) FILTER (i > k), '') AS chosen,
  coalesce(string_agg(CAST(upto - length(x) + head AS BIGINT) || '-' || CAST(upto AS BIGINT), ',' ORDER BY i) FILTER (i > k AND role = 'assistant'), '') AS chosen_mask FROM s GROUP BY conv_id),
f AS (SELECT cut.conv_id, k, prompt, chosen, chosen_mask, CASE WHEN place IS NULL OR said = other THEN '' ELSE {_turn_sql("'assistant'", 'other')} END AS rejected FROM cut JOIN g USING (conv_id))
SELECT conv_id, CAST(k AS INTEGER) AS n_prompt_turns, prompt, chosen, chosen_mask, rejected, CASE WHEN rejected = '' THEN '' ELSE '{_HEAD + 9}-' || length(rejected) END AS rejected_mask, chosen <> '' AND rejected <> '' AS paired
FROM f
"""


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item or a passage of one, by item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SEED_SQL = " UNION ALL ".join(
    "SELECT {0}, " + f"unnest(range(1, len(w) - {len(m) - 1} + 1)) AS i, unnest([" + f"'{k} ' || " + " || ' ' || ".join(f"w[x + {at}]" for at, c in enumerate(m) if c == "1") + f" FOR x IN range(1, len(w) - {len(m) - 1} + 1)]) AS key FROM {{1}} WHERE len(w) >= {len(m)}"
    for k, m in enumerate(MASKS)
)
ORACLE["op1_decontamination"] = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark),
ds AS ({_SEED_SQL.format('doc_id', 'd')}),
bs AS ({_SEED_SQL.format('item_id', 'b')}),
hits AS (SELECT DISTINCT doc_id, item_id, greatest(0, least(bs.i + 3 - 12, len(b.w) - 25)) AS o, ds.i - bs.i + greatest(0, least(bs.i + 3 - 12, len(b.w) - 25)) AS s FROM ds JOIN bs USING (key) JOIN b USING (item_id)),
laid AS (SELECT doc_id, item_id, len(b.w) AS n_words, least(25, len(b.w)) AS n_window,
    len([k FOR k IN range(1, least(25, len(b.w)) + 1) IF (s + k - 1 >= 1 AND d.w[greatest(s + k - 1, 1)] = b.w[o + k]) OR (s + k >= 1 AND d.w[greatest(s + k, 1)] = b.w[o + k]) OR (s + k + 1 >= 1 AND d.w[greatest(s + k + 1, 1)] = b.w[o + k])]) AS matched
  FROM hits JOIN d USING (doc_id) JOIN b USING (item_id))
SELECT doc_id, item_id, CAST(max(matched) AS INTEGER) AS matched, CAST(any_value(n_window) AS INTEGER) AS n_window, CAST(any_value(n_words) AS INTEGER) AS n_words FROM laid WHERE matched >= n_window * 0.7 GROUP BY doc_id, item_id
""".replace("\\\\", "\\")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with the forest's score; whether it is a secret."""
    return scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "position", "value", "score", "secret")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof; every fifth (by a hash of its id) is tampered with before its proof is folded."""
    rows = merkle_manifest(table(spark, sf_dir, "documents"), changed={"text": lower_case_tampered()})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    rows = rows.withColumns({"proof_sha256": F.sha2(siblings, 256), "folded_root": fold(F.col("candidate"), F.col("path"))})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _framed_sql(values: tuple[str, ...]) -> str:
    return " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values)


# the checksum goes bit by bit: an entry of the list is a byte to mix in, or -1 for one step
_CRC32_SQL = "xor(list_reduce(flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, CAST(4294967295 AS BIGINT)), 4294967295)"
_TAMPERED = tuple(f"translate(text, '{UPPER}', '{LOWER}')" if c == "text" else c for c in LEAF)
ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, sha256({_framed_sql(LEAF)}) AS leaf, CASE WHEN {_CRC32_SQL} % 5 = 0 THEN sha256({_framed_sql(_TAMPERED)}) ELSE sha256({_framed_sql(LEAF)}) END AS candidate FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
up AS (SELECT 0 AS level, g, pos, n, leaf AS h FROM p
  UNION ALL SELECT level + 1, g, pos // {FAN}, CAST(ceil(n / {FAN}) AS BIGINT), sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY level, g, pos // {FAN}, n),
tops AS MATERIALIZED (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
over AS (SELECT 0 AS level, pos, n, subroot AS h FROM tops
  UNION ALL SELECT level + 1, pos // {FAN}, CAST(ceil(n / {FAN}) AS BIGINT), sha256(string_agg(h, '' ORDER BY pos)) FROM over WHERE n > 1 GROUP BY level, pos // {FAN}, n),
low AS MATERIALIZED (SELECT id, level, coalesce(string_agg(h, '' ORDER BY up.pos) FILTER (up.pos < p.pos // CAST({FAN} ** level AS BIGINT)), '') AS l, coalesce(string_agg(h, '' ORDER BY up.pos) FILTER (up.pos > p.pos // CAST({FAN} ** level AS BIGINT)), '') AS r
  FROM p JOIN up ON up.g = p.g AND up.n > 1 AND up.pos // {FAN} = p.pos // CAST({FAN} ** (level + 1) AS BIGINT) GROUP BY id, level),
high AS MATERIALIZED (SELECT g, 1000 + level AS level, coalesce(string_agg(h, '' ORDER BY over.pos) FILTER (over.pos < tops.pos // CAST({FAN} ** level AS BIGINT)), '') AS l, coalesce(string_agg(h, '' ORDER BY over.pos) FILTER (over.pos > tops.pos // CAST({FAN} ** level AS BIGINT)), '') AS r
  FROM tops JOIN over ON over.n > 1 AND over.pos // {FAN} = tops.pos // CAST({FAN} ** (level + 1) AS BIGINT) GROUP BY g, level),
steps AS MATERIALIZED (SELECT id, row_number() OVER (PARTITION BY id ORDER BY level) AS k, l, r FROM (SELECT * FROM low UNION ALL SELECT id, level, l, r FROM p JOIN high USING (g))),
folded AS (SELECT id, 0 AS k, candidate AS h FROM p UNION ALL SELECT id, steps.k, sha256(l || h || r) FROM folded JOIN steps USING (id) WHERE steps.k = folded.k + 1),
proof AS (SELECT id, string_agg(l || r, '' ORDER BY k) AS s FROM steps GROUP BY id)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(s, '')) AS proof_sha256, h AS folded_root, h = root AS verified
FROM p JOIN tops USING (g) LEFT JOIN proof USING (id) JOIN (SELECT id, arg_max(h, k) AS h FROM folded GROUP BY id) USING (id), (SELECT h AS root FROM over WHERE n = 1)
"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_lexical_search"] = f"""
WITH t AS MATERIALIZED (SELECT doc_id, {_TERMS_SQL} AS ts FROM documents),
l AS MATERIALIZED (SELECT doc_id, len(ts) AS n FROM t WHERE len(ts) > 0),
g AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM l),
q AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
p AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY term, big_n),
m AS (SELECT doc_id, 75 + (25 * n * big_n) // big_l AS m FROM l, g),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
