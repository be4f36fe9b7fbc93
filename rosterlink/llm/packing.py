"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

Documents become pieces of at most ``max_tokens`` tokens. Pieces of one length are interchangeable, and so are sequences
with one gap; the range-sorted documents and gaps are therefore tables of runs: (length, first rank, count) and
(gap, first sequence, count). A round is one Spark job over these tables:

1. Range sort. Lengths and gaps lie in ranges of sizes, each range in one descending order, a gap before a length that it
   holds exactly.
2. Successor sweep, every range by itself. A piece takes the last gap that came before it and is still free: the smallest
   that holds it, as all pieces before it are longer. What finds no partner in its range goes on to one more sweep over
   the ranges' leftovers; a partner found within a range is the same that one sweep over all would find.
3. Conflicts. Of pieces of one length and gaps of one size, the k-th takes the k-th.
4. Update. Gaps shrink by what they took, and the rounds repeat.

Lengths are taken in bands, each down to half of its longest, longest band first. Before a band's single pieces are
matched, bundles of 2, 4, ... equal pieces are, where gaps could hold them. When few pieces of a band still find a gap,
the rest opens new sequences, full ones first. The tables of runs have at most ``max_tokens`` lengths and a few thousand
gaps, whatever the corpus. Pieces themselves are ranked and joined with their runs once, at the end, in lanes whose number
follows their count.
"""

from __future__ import annotations

import array
import zlib

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlink.llm.common import materialise, text_batches

#: Words and word parts whose ids a task keeps.
CACHE = 500_000
#: Rows of one lane of a length; runs that are broadcast (60 bytes each): more of them are joined where the pieces lie.
LANE_ROWS, BROADCAST_RUNS = 100_000, 200_000
#: Ranges of sizes that a sweep runs over by themselves.
RANGES = 8
#: A band's sweeps end when one places less than this share of what it leaves.
LEAST_SHARE = 0.25
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[\x21-\x7e\xa1-įı-ɏ]*")


def _byte_table() -> dict[int, str]:
    """The printable stand-ins of bytes that byte-level vocabularies use, where they differ from Latin-1."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}


class WordIds(dict):
    """Ids (bytes, little-endian unsigned 32 bits) of the words of a text, remembered.

    White space always ends a token of this kind of vocabulary, so a text's ids are those of its words. Words of plain
    Latin text are lower-cased, cut by the vocabulary's own pattern and given to the library's BPE model; all others, and
    those that may hold a special token, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.table, self.parts = self.tokenizer.model, _byte_table(), {}

    def whole(self, word: str) -> bytes:
        return array.array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        out = self.parts.get(part)
        if out is None:
            key = part if part.isascii() else part.encode().decode("latin-1").translate(self.table)
            out = self.parts[part] = array.array("I", [t.id for t in self.model.tokenize(key)]).tobytes()
        return out

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            out = self._part(word.lower())
        elif "<|" in word or not _PLAIN.fullmatch(word):
            out = self.whole(word)
        else:
            out = b"".join(map(self._part, _SPLIT.findall(word.lower())))
        self[word] = out
        return out

    def ids(self, text: str) -> bytes:
        if len(self) > CACHE:
            self.clear()
        if len(self.parts) > CACHE:
            self.parts.clear()
        plain = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.__getitem__, (plain.lower() if plain.isascii() and "<|" not in plain else plain).split(" ")))


def _pieces(path: str, max_tokens: int, end_id: int):
    def run(batches):
        words = WordIds(path)
        end = array.array("I", [end_id]).tobytes()
        for batch in batches:
            rows = []
            for d, text in zip(batch.column(0), batch.column(1)):
                ids = words.ids(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at : at + 4 * max_tokens]
                    rows.append((d.as_py(), k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """Rows ``(id_col, piece, start, length, ids_crc32)``: each document's ids, then ``end_id``, cut every ``max_tokens``.

    A null or empty text is ``end_id`` alone; repeated rows give repeated pieces; null ids stay; other columns are not
    read. The vocabulary file must be on every executor. A worker holds one text with its ids (4 bytes each) at a time.
    """
    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    cut = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = cut.mapInArrow(_pieces(tokenizer_path, max_tokens, end_id), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("doc_id", id_col)


_COLUMNS = ["kind", "size", "first", "n", "seq", "at", "copies"]
#: Kinds: ``gap`` (size, first sequence, count), ``doc`` (length, first rank, count), ``place`` (the columns of
#: ``place_runs``), ``band`` (its number; shortest length, pieces, pieces of one length at most, gaps that hold any, largest gap).
_RUNS = "kind string, size long, first long, n long, seq long, at long, copies long"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame([(*r, *(0,) * (7 - len(r))) for r in rows], columns=_COLUMNS)
    return out.astype({c: "int64" for c in _COLUMNS[1:]})


def _sweep(runs: list[tuple], low: int, high: int, bundle: int, max_tokens: int) -> list[tuple]:
    """One descending sweep: bundles of pieces with ``low`` < length <= ``high`` take the smallest gaps that hold them.

    Gaps that took something are ``new``: they wait for the next round. All other rows come back as they are.
    """
    out, events = [], []
    for r in runs:
        if r[0] == "gap":
            events.append((-r[1], 0, -r[2], r))
        elif r[0] == "doc" and low < r[1] <= high:
            events.append((-r[1] * bundle, 1, 0, r))
        else:
            out.append(r)
    free: list[list[int]] = []  # gaps that came by and are free: size, first sequence, count; the smallest last
    for _, is_doc, _, (_, size, first, n, *_) in sorted(events):
        if not is_doc:
            free.append([size, first, n])
            continue
        while n >= bundle and free:
            gap, seq, count = free[-1]
            k = min(n // bundle, count)
            out.append(("place", size, first, k * bundle, seq, max_tokens - gap, bundle))
            if gap > size * bundle:
                out.append(("new", gap - size * bundle, seq, k))
            first, n = first + k * bundle, n - k * bundle
            free[-1][1:] = seq + k, count - k
            if k == count:
                free.pop()
        if n:
            out.append(("doc", size, first, n))
    return out + [("gap", *g) for g in free]


def _joined(rows: list[tuple]) -> list[tuple]:
    """Neighbouring runs of equal gaps made one, so that their number does not grow with the rounds."""
    out: list[tuple] = []
    for r in sorted((("gap", *r[1:4]) if r[0] == "new" else r) for r in rows if r[0] in ("gap", "new")):
        if out and out[-1][1] == r[1] and out[-1][2] + out[-1][3] == r[2]:
            out[-1] = ("gap", r[1], out[-1][2], out[-1][3] + r[3])
        else:
            out.append(r)
    return out + [r for r in rows if r[0] not in ("gap", "new")]


def _written(rows: list[tuple], max_tokens: int) -> pd.DataFrame:
    """A round's rows and what decides on the next one, by band."""
    rows = _joined(rows)
    docs, gaps = ([r for r in rows if r[0] == kind] for kind in ("doc", "gap"))
    for b, (low, high) in enumerate(_bands(max_tokens)):
        own = [r for r in docs if low < r[1] <= high]
        if own:
            rows.append(("band", b, min(r[1] for r in own), sum(r[3] for r in own), max(r[3] for r in own), sum(r[3] for r in gaps if r[1] >= high), max((r[1] for r in gaps), default=0)))
    return _frame(rows)


def _runs_of(frames) -> list[tuple]:
    """All rows of a table of runs but those of its last round's results; bounded, see the module's text."""
    frames = list(frames)
    rows = pd.concat(frames)[_COLUMNS].itertuples(index=False, name=None) if frames else ()
    return [r for r in rows if r[0] != "band"]


def _round(state: DataFrame, low: int, high: int, bundle: int, max_tokens: int) -> DataFrame:
    """One sweep of a band: within the ranges, then over what they leave."""
    size = F.when(F.col("kind") == "doc", F.col("size") * bundle).otherwise(F.col("size"))
    ranged = state.withColumn("range", F.floor(size * RANGES / (max_tokens + 1)))
    within = ranged.groupBy("range").applyInPandas(lambda runs: _frame(_sweep(_runs_of([runs]), low, high, bundle, max_tokens)), _RUNS)

    def leftovers(frames):
        yield _written(_sweep(_runs_of(frames), low, high, bundle, max_tokens), max_tokens)

    return within.coalesce(1).mapInPandas(leftovers, _RUNS)


def _opened(state: DataFrame, low: int, high: int, base: int, last: bool, max_tokens: int) -> DataFrame:
    """New sequences, numbered from ``base``: full ones of equal pieces; of the rest, so many as it needs at least take one
    piece each, longest first. ``last``: every piece of the rest opens one."""

    def run(frames):
        out, rest, seq = [], [], base
        for r in sorted(_runs_of(frames), key=lambda r: (-r[1], r[2])):
            kind, size, first, n, *_ = r
            if kind != "doc" or not low < size <= high:
                out.append(r)
                continue
            copies = max_tokens // size
            full = 0 if last else n // copies
            if full:
                out.append(("place", size, first, full * copies, seq, 0, copies))
                if max_tokens > size * copies:
                    out.append(("gap", max_tokens - size * copies, seq, full))
                seq += full
            if n > full * copies:
                rest.append((size, first + full * copies, n - full * copies))
        each = 1 if last else max_tokens // high
        need = -(-sum(n for *_, n in rest) // each)
        for size, first, n in rest:
            take = min(need, n)
            if take:
                out.append(("place", size, first, take, seq, 0, 1))
                if max_tokens > size:
                    out.append(("gap", max_tokens - size, seq, take))
                seq, need = seq + take, need - take
            if n > take:
                out.append(("doc", size, first + take, n - take))
        yield _written(out, max_tokens)

    return state.coalesce(1).mapInPandas(run, _RUNS)


def _bands(max_tokens: int) -> list[tuple[int, int]]:
    """``(low, high]``, from the longest down."""
    out, high = [], max_tokens
    while high:
        out.append((high // 2, high))
        high //= 2
    return out


class _Rounds:
    """The tables of runs, written once a round; the driver sees a row a band."""

    def __init__(self, docs: DataFrame, max_tokens: int):
        self.max_tokens, self.bands, self.placed = max_tokens, _bands(max_tokens), []
        self.step(docs.coalesce(1).mapInPandas(lambda frames: iter([_written(_runs_of(frames), max_tokens)]), _RUNS))

    def step(self, state: DataFrame) -> None:
        state = materialise(state)
        self.placed.append(state)
        self.state = state.where("kind in ('gap', 'doc')")
        self.seen = {r.size: r for r in state.where("kind = 'band'").collect()}

    def left(self, b: int) -> int:
        return self.seen[b].n if b in self.seen else 0

    def fill(self, b: int) -> None:
        """Sweeps of band ``b``, bundles first, until few of its pieces find a gap."""
        low, high = self.bands[b]
        bundle = 1 << (self.max_tokens // high).bit_length() - 1
        while bundle and self.left(b):
            before, band = self.left(b), self.seen[b]
            least, most, room, gap = band.first, band.seq, band.at, band.copies
            if gap < bundle * least or most < bundle or (bundle > 1 and before <= 2 * room):
                bundle //= 2  # no gap, no bundle, or room enough for single pieces in two sweeps
                continue
            self.step(_round(self.state, low, high, bundle, self.max_tokens))
            if bundle > 1:
                bundle //= 2
            elif before - self.left(b) < LEAST_SHARE * self.left(b):
                break

    def run(self) -> DataFrame:
        """All rounds; the rows of kind ``place`` of every round."""
        for b, (low, high) in enumerate(self.bands):
            for last in (False, True):
                self.fill(b)
                if self.left(b):
                    self.step(_opened(self.state, low, high, (2 * b + last) << 44, last, self.max_tokens))
        spark = self.state.sparkSession
        return spark.read.schema(_RUNS).parquet(*(p._written_to for p in self.placed)).where("kind = 'place'")


def place_runs(counts: DataFrame, max_tokens: int) -> DataFrame:
    """Rows ``(size, first, n, seq, at, copies)`` for ``counts`` (length, n).

    Of the pieces of length ``size``, that with rank ``first + i``, i < n, goes to sequence ``seq + i // copies``, at offset
    ``at + i % copies * size``. Every rank of every length is in one row.
    """
    given = {"kind": F.lit("doc"), "size": F.col("length").cast("long"), "n": F.col("n").cast("long")}
    docs = counts.select(*(given.get(c, F.lit(0).cast("long")).alias(c) for c in _COLUMNS))
    return _Rounds(docs.coalesce(1), max_tokens).run().drop("kind")


def pack(pieces: DataFrame, max_tokens: int = 2048) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``max_tokens``) plus ``sequence_id`` and ``offset``.

    Sequences are gapless from 0 and their numbers are not consecutive. Repeated rows, rows with equal or null ids and
    rows of one length are placed as separate pieces. Other columns are kept. An empty table gives no rows.
    """
    names = pieces.columns
    pieces = materialise(pieces.withColumn("__row", F.monotonically_increasing_id()))
    counts = materialise(pieces.groupBy("length").agg(F.count("*").alias("n")).coalesce(1))  # max_tokens rows at most
    runs = place_runs(counts, max_tokens)
    # a lane of a length is at most about LANE_ROWS rows, so no length is ranked by one task
    lanes = counts.select(F.col("length").alias("__length"), (F.lit(1) + F.floor(F.col("n") / LANE_ROWS)).alias("__lanes"))
    rows = pieces.join(F.broadcast(lanes), F.col("length") == F.col("__length")).withColumn("__lane", F.pmod(F.xxhash64("__row"), F.col("__lanes"))).drop("__lanes", "__length")
    lane = materialise(rows.groupBy("length", "__lane").agg(F.count("*").alias("n")))
    before = Window.partitionBy("length").orderBy("__lane").rowsBetween(Window.unboundedPreceding, -1)
    lane = lane.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    end = F.col("base") + F.col("lane_n")
    of = lane.select(F.col("length").alias("__of"), F.col("__lane").alias("__at"), "base", F.col("n").alias("lane_n"))
    of = of.join(runs, (F.col("__of") == F.col("size")) & (F.col("first") < end) & (F.col("base") < F.col("first") + F.col("n")))
    of = materialise(of.select("__of", "__at", F.col("base").alias("__base"), F.col("first").alias("__first"), F.col("n").alias("__n"), "seq", "at", "copies"))
    inside = Window.partitionBy("length", "__lane").orderBy("__row")
    ranked = rows.withColumn("__rank", F.row_number().over(inside) - 1)
    i = F.col("__base") + F.col("__rank") - F.col("__first")
    placed = ranked.join(F.broadcast(of) if of.count() <= BROADCAST_RUNS else of, (F.col("length") == F.col("__of")) & (F.col("__lane") == F.col("__at")) & (i >= 0) & (i < F.col("__n")))
    return placed.select(*names, (F.col("seq") + F.floor(i / F.col("copies"))).cast("long").alias("sequence_id"), (F.col("at") + i % F.col("copies") * F.col("length")).cast("long").alias("offset"))
