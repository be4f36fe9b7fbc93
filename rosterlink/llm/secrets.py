"""Secret scans: candidate strings, and a random forest that removes false positives.

A candidate is a value in a known format, a value that an announcing name and an assignment precede (of any length, with
or without digits; without quotes it ends at white space, commas, brackets or '&'), the value of ``user:value@host``, or
a run of at least 12 characters that tokens are made of, one a digit. What the forest sees of it: its
length, the shares and transitions of its character classes, how much of it words of the corpus cover, and the hashed
words of its path and beside it. It is trained from labelled findings; formats, quotes and the lists of announcing and
dummy words, which serve to find candidates and to label findings where a table has no labels, are no features.
Everything is DataFrame expressions and the JVM's forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.llm.common import materialise

#: Characters of a token run; '=' belongs to it only as trailing padding, '.' only inside.
_SET = r"A-Za-z0-9+/_\-.@"
_QUOTE = "\"'`"
_NAMES = r"token|secret|passw(?:or)?d|pwd|api[_-]?key|aws[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|bearer|credentials?"
#: The end of an announcing name and its assignment: NAME=value, "name": "value", name: Bearer value.
_ASSIGN = rf"(?:[_-]?[0-9]{{1,4}})?[{_QUOTE}]?\s{{0,9}}(?:=>|:=|=|:)\s{{0,9}}(?:(?i:bearer|basic|token)[ \t]++)?+[{_QUOTE}]?+"
_ASSIGNED_VALUE = rf"(?<=[{_QUOTE}])[^{_QUOTE}\n]++(?=[{_QUOTE}])|[^\s{_QUOTE},;&<>(){{}}\[\]]*[^\s{_QUOTE},;&<>(){{}}\[\].:!?]"
#: user:value@host; after a name that announces a mail address only behind '://', and there the value may be anything.
_CREDENTIAL = rf"(://[^\s/?#:@{_QUOTE}]*+:)([^\s/?#@{_QUOTE}]++)(?=@)|((?<![A-Za-z0-9_.+\-])(?!(?i:mailto|e-?mail|mail|contact|from|to|cc|bcc|reply-to|sips?|xmpp|acct):)[A-Za-z0-9_.+\-]{{1,64}}+:)((?=[^\s/@:0-9]*+[0-9])[^\s/@:{_QUOTE}]++)(?=@[A-Za-z0-9])"
#: A whole run of token characters, 12 or more, with a digit in it, that is no announcing name before its assignment.
_RUN = rf"(?:\G|(?<![{_SET}]))(?=[A-Za-z+/_\-.@]*+[0-9])(?![{_SET}]*+(?<=(?i:{_NAMES})(?:[_-]?[0-9]{{1,4}})?)[{_QUOTE}]?\s{{0,9}}[=:])[{_SET}]{{11,}}[A-Za-z0-9+/_\-@](?:={{1,2}}(?![{_SET}=]))?+"
MARK, KEEP = "\u0001", "\u0002"
# Well-known public formats of credentials, words that announce one, words that announce a dummy.
_KEY_BLOCK = r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]++-----END (?:[A-Z]+ )*PRIVATE KEY-----"
FORMATS = rf"^({_KEY_BLOCK}|AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{36,}}|xox[abprs]-[A-Za-z0-9-]{{10,}}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\..*|sk-[A-Za-z0-9]{{20,}})$"
#: The same formats wherever they stand in a run, at its end or before a full stop.
_FORMAT_WITHIN = _KEY_BLOCK + r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_.-]*+(?<!\.)|sk-[A-Za-z0-9]{20,}+)"
_NAME = rf"(?i)(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:{_NAMES})(?![A-Za-z])"
ANNOUNCE = _NAME
CANDIDATE = rf"(?:((?:{_NAME}){_ASSIGN})(?!{KEEP})({_ASSIGNED_VALUE})|{_CREDENTIAL}|({KEEP}[^{KEEP}]*+{KEEP}|{_RUN}))"
DUMMY = r"(?i)\b(example|sample|dummy|fake|test|placeholder|mock|xxx+)\b"
#: Character classes (digit, lower case, upper case, '@', '.', any other) and what the forest sees of a value.
_CLASSES = "0aA@._"
NUMBERS = ["length", "covered", *(f"share_{c}" for c in range(len(_CLASSES))), *(f"from_{a}_to_{b}" for a in range(len(_CLASSES)) for b in range(len(_CLASSES)))]
#: Buckets of the hashed words, and words on either side.
BUCKETS, NEIGHBOURS = 128, 4


def _parts(text: Column) -> Column:
    """The text cut around its candidates: candidates are the elements with odd positions (from 0)."""
    clean = F.translate(F.coalesce(text, F.lit("")), MARK + KEEP, "  ")
    formats = F.regexp_replace(clean, _FORMAT_WITHIN, f"{KEEP}$0{KEEP}")
    marked = F.regexp_replace(formats, CANDIDATE, f"$1$3$5{MARK}$2$4$6$7{MARK}")
    return F.split(F.replace(marked, F.lit(KEEP), F.lit("")), MARK)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", context: int = 40) -> DataFrame:
    """Rows ``(id, path, value, before, after, position, candidate, text_hash)``: every candidate with ``context`` characters on either side.

    ``position`` is the candidate's first character and ``candidate`` its number in the text, both from 0. Null and empty
    texts have no candidates. Each text is cut once; what moves is a small row a candidate, so a text's work grows with
    its length alone.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(path, F.lit("")).alias("path"), F.col(text_col).alias("text"))
    rows = rows.select("id", "path", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"), _parts(F.col("text")).alias("parts"))

    def one(i: Column) -> Column:
        part = lambda k: F.get("parts", i + k)
        return F.struct(part(0).alias("value"), F.right(part(-1), F.lit(context)).alias("before"), F.left(part(1), F.lit(context)).alias("after"), F.length(part(-1)).alias("gap"))

    none = F.array().cast("array<int>")
    odd = F.when(F.size("parts") > 1, F.sequence(F.lit(1), F.greatest(F.size("parts") - 2, F.lit(1)), F.lit(2))).otherwise(none)
    found = rows.select("id", "path", "text_hash", "row", F.posexplode_outer(F.transform(odd, one)).alias("candidate", "c")).where("candidate is not null")
    found = found.select("id", "path", "text_hash", "row", "candidate", "c.*")
    so_far = Window.partitionBy("row").orderBy("candidate")
    position = F.sum(F.col("gap") + F.length("value")).over(so_far) - F.length("value")
    return found.select("id", "path", "value", "before", "after", position.cast("long").alias("position"), "candidate", "text_hash")


def corpus_dictionary(docs: DataFrame, text_col: str = "text", words: int = 5000) -> list[str]:
    """The ``words`` most frequent words of at least three letters a-z, counted over all texts."""
    each = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("w")).where("length(w) >= 3")
    return sorted(r.w for r in each.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words).collect())


def with_features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """``found`` plus ``features``: the columns of ``NUMBERS`` and the hashed words of path and neighbourhood."""
    kinds = F.col("value")
    for pattern, c in (("[^0-9a-zA-Z@.]", "_"), ("[0-9]", "0"), ("[a-z]", "a"), ("[A-Z]", "A")):
        kinds = F.regexp_replace(kinds, pattern, c)
    # at most ``corpus_dictionary(words)`` words
    known = ", ".join(f"'{w}'" for w in dictionary) or "''"
    covered = F.expr(f"aggregate(filter(regexp_extract_all(lower(value), '([a-z]{{3,}})', 1), w -> w IN ({known})), 0, (s, w) -> s + length(w))")
    split = lambda c: F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: w != "")
    marked = lambda words, mark: F.transform(words, lambda w: F.concat(F.lit(mark), w))
    left, right = split("before"), split("after")
    words = F.concat(
        marked(F.slice(F.reverse(left), F.lit(1), F.lit(NEIGHBOURS)), "<"), marked(F.slice(right, F.lit(1), F.lit(NEIGHBOURS)), ">"), marked(split("path"), "/")
    )
    out = found.withColumns({"kinds": kinds, "words": words, "length": F.greatest(F.length("value"), F.lit(1)).cast("double")})
    q = lambda c: f"[{c}]"
    share = lambda pattern: (F.regexp_count("kinds", F.lit(pattern)) / F.col("length")).cast("double")
    out = out.withColumns({
        "covered": (covered / F.col("length")).cast("double"), **{f"share_{k}": share(q(c)) for k, c in enumerate(_CLASSES)},
        **{f"from_{i}_to_{k}": share(f"{q(a)}(?={q(b)})") for i, a in enumerate(_CLASSES) for k, b in enumerate(_CLASSES)},
    })
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="words", outputCol="near").transform(out)
    return VectorAssembler(inputCols=[*NUMBERS, "near"], outputCol="features").transform(hashed)


def _rule() -> tuple[Column, Column, Column]:
    """Conditions on a candidate: certainly no secret, certainly one, and one announced and assigned in any way."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    assigned = before.rlike(ANNOUNCE + _ASSIGN + "$")
    credential = before.rlike(rf"://[^\s/?#:@{_QUOTE}]*:$") & after.startswith("@")
    quoted = before.rlike(rf"[{_QUOTE}]$") & after.rlike(rf"^[{_QUOTE}]")
    plain = value.rlike(r"^[^@]+@[^@]+\.[^@]+$|^[0-9.\-/+=_]+$")
    no = (plain & ~(assigned & quoted) & ~credential) | F.concat_ws(" ", "before", "after").rlike(DUMMY)
    yes = value.rlike(FORMATS) | credential | (assigned & value.rlike("[0-9]") & (quoted | before.endswith("=")))
    return no, yes, assigned


def labelled_by_rule(found: DataFrame) -> DataFrame:
    """Findings with certain labels, for data without any: formats, credentials of URLs and announced, assigned values
    with a digit (quoted, or right after '=') are secrets; other mail addresses, network addresses and plain numbers are
    not, nor are dummies. All others are left out."""
    no, yes, _ = _rule()
    return found.withColumn("label", F.when(no, 0.0).when(yes, 1.0)).where("label is not null")


class SecretModel:
    """A forest (None where the labels had one class or none: then the rule of ``labelled_by_rule`` decides) and its dictionary."""

    def __init__(self, forest: RandomForestClassificationModel | None, dictionary: list[str]):
        self.forest, self.dictionary = forest, dictionary

    def score(self, found: DataFrame, threshold: float = 0.5) -> DataFrame:
        """``found`` plus ``score`` and ``secret`` (score at least ``threshold``)."""
        if self.forest is None:
            no, yes, assigned = _rule()
            return found.withColumn("score", F.when(no, 0.0).when(yes | assigned, 1.0).otherwise(0.0)).withColumn("secret", F.col("score") >= threshold)
        out = self.forest.transform(with_features(found, self.dictionary)).select(*found.columns, F.round(vector_to_array("probability")[1], 6).alias("score"))
        return out.withColumn("secret", F.col("score") >= threshold)


def fit_secrets(labelled: DataFrame, dictionary: list[str] = (), max_findings: int = 4000, trees: int = 30, depth: int = 8, seed: int = 7) -> SecretModel:
    """Train on labelled findings (columns of ``candidates`` and ``label`` 0.0 or 1.0), with the words of ``dictionary``.

    At most ``max_findings`` of each class are used, in hash order.
    """
    order = [F.xxhash64("value", "before", "after"), F.col("value"), F.col("before"), F.col("after"), F.col("path"), F.col("id")]
    part = [labelled.where(F.col("label") == y).orderBy(*order).limit(max_findings) for y in (0.0, 1.0)]
    sample = materialise(part[0].unionByName(part[1]))
    if sample.select("label").distinct().count() < 2:
        return SecretModel(None, list(dictionary))
    data = materialise(with_features(sample, list(dictionary)).select("features", "label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", subsamplingRate=0.8)
    return SecretModel(forest.fit(data), list(dictionary))


def scan_secrets(docs: DataFrame, model: SecretModel | None = None, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Rows ``(id_col, position, value, score, secret, candidate, text_hash)`` for every candidate of every row of ``docs``.

    Without a ``model`` one is trained from ``labelled`` findings, without those from the candidates that
    ``labelled_by_rule`` can label. Null and empty texts have no candidates, repeated rows repeat theirs, null ids are
    kept, other columns are not read; a very long text is cut in one pass. Without labels of both classes the rule
    decides: certain and announced, assigned values are secrets, all others are not. Empty tables give no rows.
    """
    found = materialise(candidates(docs, id_col, text_col, path_col))
    if model is None:
        model = fit_secrets(labelled if labelled is not None else labelled_by_rule(found), corpus_dictionary(docs, text_col))
    return model.score(found).select(F.col("id").alias(id_col), "position", "value", "score", "secret", "candidate", "text_hash")


def redact(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[REDACTED]", broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with the secrets of ``findings`` (of ``scan_secrets``) replaced by ``mask``; all rows and columns stay.

    A finding belongs to the rows of its id and text, so rows that share an id keep their own secrets. Decisions are
    joined by a broadcast if at most ``broadcast_rows`` candidates stand in texts with a secret, else by a shuffle.
    """
    by = findings.groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"))
    of = by.agg(F.array_sort(F.collect_set(F.struct("candidate", "secret"))).alias("__found"), F.max("secret").alias("__any")).where("__any")
    of = materialise(of.select("__id", "__hash", F.transform("__found", lambda x: x["secret"]).alias("__secret")))
    small = (of.agg(F.sum(F.size("__secret"))).first()[0] or 0) <= broadcast_rows
    rows = docs.join(F.broadcast(of) if small else of, docs[id_col].eqNullSafe(of["__id"]) & (F.xxhash64(docs[text_col]) == of["__hash"]), "left")
    parts = F.transform(_parts(F.col(text_col)), lambda p, i: F.when((i % 2 == 1) & F.get("__secret", F.floor(i / 2).cast("int")), F.lit(mask)).otherwise(p))
    text = F.when(F.col("__secret").isNotNull(), F.array_join(parts, "")).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).select(*docs.columns)
