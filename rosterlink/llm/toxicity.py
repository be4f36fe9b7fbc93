"""Toxicity by a weighted lexicon: folding, Aho-Corasick matching, exception phrases, length-normalised scores.

Texts and entries are folded alike: lower case, compatibility forms and accents removed, look-alike letters of other
scripts and digits or signs inside words read as the Latin letters they stand for, every run of other characters a
space. An entry matches at the start of a word and, if it ends in a space, only a whole word. A match inside an
exception phrase does not count. The score is logistic in the summed weights and in their share of the text's length.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.calibrate import fit_logistic
from rosterlink.llm.common import materialise, text_batches

# Letters of other scripts that look like Latin ones, and what digits and signs inside words stand for.
LOOK_ALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "п": "n",
    "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ѵ": "v", "ѡ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "ı": "i", "ł": "i", "ø": "o", "l": "i", "£": "i", "€": "e"}
_SIGN = re.compile(r"(?<=[^\W_])[@$!|€£]+(?=[^\W_])")


class _Fold(dict):
    """A character's folded form, worked out when it is first seen."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if unicodedata.category(c) in ("Mn", "Cf"):
            out = ""
        else:
            c = LOOK_ALIKE.get(c, c)
            c = STANDS_FOR.get(c, c) if c not in "@$!|€£" else " "
            out = c if c.isalnum() else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """The folded text with single spaces around every word."""
    text = text.lower()
    text = _SIGN.sub(lambda m: "".join(STANDS_FOR[c] for c in m.group()), text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower()
    return f" {' '.join(text.translate(_FOLD).split())} "


@dataclass
class Lexicon:
    """Entries (folded, a space before, a space after for a whole word) with weights; exception phrases; calibration."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    calibration: tuple[float, ...] = (1.0, 0.0, -2.0)


def _matcher(lexicon: Lexicon):
    """A function from folded text to the summed weight of its matches."""
    auto, empty = ahocorasick.Automaton(), True
    for e in lexicon.exceptions:
        auto.add_word(e, (len(e), None))
        empty = False
    for e, w in lexicon.weights.items():
        auto.add_word(e, (len(e), w))
        empty = False
    if empty:
        return lambda text: 0.0
    auto.make_automaton()

    def total(text: str) -> float:
        found, safe = [], []
        for end, (n, w) in auto.iter(text):
            (safe.append((end - n + 1, end)) if w is None else found.append((end - n + 1, end, w)))
        if safe and found:
            safe.sort()
            reach = np.maximum.accumulate([b for _, b in safe])
            starts = [a for a, _ in safe]
            found = [(a, b, w) for a, b, w in found if not (k := np.searchsorted(starts, a, "right")) or reach[k - 1] < b - text[b].isspace()]
        best = {}
        for a, _, w in found:  # entries that begin at one word count once, with the largest weight
            best[a] = max(best.get(a, 0.0), w)
        return sum(best.values())

    return total


def _features(lexicon, keep_text: bool = False):
    """(sum, length) of each text: the matcher's total and the number of folded words, beside the other columns."""

    def run(batches):
        total = _matcher(lexicon.value)
        for batch in batches:
            names = batch.schema.names
            x, n = [], []
            for t in batch.column(names.index("text")):
                folded = fold(t.as_py() or "")
                x.append(total(folded))
                n.append(folded.count(" ") - 1)
            keep = [c for c in names if keep_text or c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in keep), pa.array(x, pa.float64()), pa.array(n, pa.int64())], [*keep, "x", "n"])

    return run


_COUNTS = "e string, a long, b long"


def _counted(pieces):
    """For each piece of the folded texts, in how many toxic (a) and clean (b) texts of the task it is."""

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece in pieces(set(fold(t.as_py() or "").split())):
                    counts.setdefault(piece, [0, 0])[1 - y] += 1
        names, pairs = list(counts), list(counts.values())
        for k in range(0, len(names), 50_000):
            part = pairs[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(names[k : k + 50_000], pa.string()), pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int64())], ["e", "a", "b"])

    return run


def _beginnings(words) -> set[str]:
    """Beginnings of 4 to 12 letters, with a space before."""
    return {f" {w[:k]}" for w in words for k in range(4, min(len(w), 12) + 1)}


def fit_lexicon(sample: DataFrame, exceptions: list[str] | None = None, max_entries: int = 2000, support: int = 4) -> Lexicon:
    """Learn entries, weights, exception phrases and the calibration from a bounded ``sample`` (label 0 or 1, text, row).

    Entries are whole words and word beginnings of 4 to 12 letters in at least ``support`` toxic texts whose weight, the
    smoothed log odds, is 2 or more; the ``max_entries`` with the largest z-score stay. A word that is as common in
    clean texts as in toxic ones becomes an exception phrase where an entry begins it. ``exceptions`` adds phrases of
    the caller. Every exception that an entry needs is kept: they are words of the sample, of at least ten of its rows.
    """
    spark = sample.sparkSession
    text_batches(spark)
    size = {y: n for y, n in sample.groupBy("label").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    weight = F.log((F.col("a") + 0.5) / (pos + 1.0)) - F.log((F.col("b") + 0.5) / (neg + 1.0))
    z = weight / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))

    def counted(pieces) -> DataFrame:
        rows = sample.select("label", "text").mapInArrow(_counted(pieces), _COUNTS)
        return rows.groupBy("e").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    counts = materialise(counted(lambda words: words))
    # words of at least ten rows of the sample that say little: no beginning is learned from them
    common = [r.e for r in counts.where((F.col("a") + F.col("b") >= 10) & (weight < 1.5)).select("e").collect()]
    plain = spark.sparkContext.broadcast(frozenset(common))
    begins = counted(lambda words: _beginnings(words - plain.value)).where(F.col("a") >= support)
    whole = counts.select(F.concat(F.lit(" "), "e", F.lit(" ")).alias("e"), "a", "b")
    entries = begins.unionByName(whole).withColumn("w", weight).withColumn("z", z)
    entries = entries.where((F.col("a") >= support) & (F.col("w") >= 2.0)).orderBy(F.desc("z"), "e").limit(max_entries).collect()
    kept: dict[str, float] = {}
    for r in entries:  # best first; a longer form of an entry that is already there adds nothing unless it weighs more
        shorter = [kept[r.e[:k]] for k in range(2, len(r.e)) if r.e[:k] in kept]
        if not shorter or r.w > max(shorter) + 0.5:
            kept[r.e] = float(r.w)
    safe = set(map(fold, exceptions or ()))
    starts = {e for e in kept if not e.endswith(" ")}
    safe |= {f" {w} " for w in common if not starts.isdisjoint(_beginnings([w]))}
    lexicon = Lexicon(kept, sorted(safe))
    shared = spark.sparkContext.broadcast(lexicon)
    got = sample.select("label", "text").mapInArrow(_features(shared), "label int, x double, n long").collect()
    y, x, n = (np.array(c, float) for c in (zip(*got) if got else ((), (), ())))
    w = fit_logistic(np.column_stack([np.log1p(x), x / np.sqrt(n + 1)]), y, ridge=1e-4)
    lexicon.calibration = tuple(map(float, w))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Rows ``(id_col, toxic_weight, n_words, score, predicted)`` for every row of ``docs``.

    Whole texts are matched; a worker holds one text and its folded form at a time. A null, empty or wordless text has
    weight 0 and the calibration's score of no match; so has any text where the lexicon is empty. Repeated rows give
    repeated results; null ids stay; other columns are not read.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kind = docs.schema[id_col].dataType.simpleString()
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_features(shared), f"id {kind}, x double, n long")
    out = x.select(F.col("id").alias(id_col), F.col("x").alias("toxic_weight"), F.greatest("n", F.lit(0)).alias("n_words"), _score(lexicon).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _score(lexicon: Lexicon) -> Column:
    a, b, c = lexicon.calibration
    return 1 / (1 + F.exp(-(F.log1p("x") * a + F.col("x") / F.sqrt(F.col("n") + 1) * b + c)))


def without_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``; no join, so no text moves.

    Rows with null, empty or wordless texts stay, as do repeated rows and rows without an id; no column's name matters.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    flat = docs.toDF(*("text" if i == at else c for i, c in enumerate(names)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema)
    out = flat.mapInArrow(_features(shared, keep_text=True), f"{fields}, x double, n long").where(_score(lexicon) < threshold)
    return out.drop("x", "n").toDF(*docs.columns)
