"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for a text of n code points, the n + 1 prefix values of a polynomial hash modulo two primes below
2**31. The hash of any span follows from two of them, so spans are compared in constant time and the longest common
extension of two positions is found by binary search. The fingerprint of a text is the bottom sketch of the hashes of
all its windows of ``WINDOW`` code points; the likeness of two fingerprints estimates the Jaccard similarity of the
windows, so equal texts have equal fingerprints and likeness 1, whatever has moved.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlink.llm.common import materialise, text_batches

#: Two primes below 2**31 and a base for each.
PRIMES, BASES = (2147483647, 2147483629), (911382323, 972663749)
WINDOW, SKETCH = 12, 64
#: Powers that a worker keeps for each base; those of a longer text are made for it alone.
KEPT = 1 << 18
_tables: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    have = _tables.get((base, prime))
    if have is None:
        have = np.array([1], np.uint64)
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), prime)) % np.uint64(prime)])
    _tables[base, prime] = have if len(have) <= KEPT else have[:KEPT].copy()
    return have[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class PrefixHash:
    """Prefix hash arrays of one text; lists of code points are accepted too."""

    def __init__(self, text):
        points = code_points(text) if isinstance(text, str) else np.asarray(text, np.uint64)
        self.n = len(points)
        self.prefix = []
        for p, b in zip(PRIMES, BASES):
            h = np.zeros(self.n + 1, np.uint64)
            np.cumsum((points + np.uint64(1)) * _powers(b, p, self.n) % np.uint64(p), out=h[1:])
            self.prefix.append(h % np.uint64(p))

    def spans(self, start, end) -> np.ndarray:
        """Hashes (below 2**62) of the spans start..end (arrays or numbers)."""
        start, end = np.atleast_1d(start), np.atleast_1d(end)
        out = np.zeros(len(start), np.uint64)
        for h, p, b in zip(self.prefix, PRIMES, BASES):
            q = np.uint64(p)
            down = _powers(pow(b, -1, p), p, self.n + 1)[start]
            out = (out << np.uint64(31)) | ((h[end] + q - h[start]) * down % q)
        return out

    def equal(self, i: int, j: int, length: int, other: PrefixHash | None = None) -> bool:
        """Whether this text's span of ``length`` at i equals the other's at j."""
        other = other or self
        if i < 0 or j < 0 or i + length > self.n or j + length > other.n:
            return False
        return bool(self.spans(i, i + length)[0] == other.spans(j, j + length)[0])

    def common_extension(self, i: int, j: int, other: PrefixHash | None = None) -> int:
        """The longest length at which the spans at i (here) and j (in the other) agree."""
        other = other or self
        low, high = 0, max(0, min(self.n - i, other.n - j))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.equal(i, j, mid, other) else (low, mid - 1)
        return low

    def fingerprint(self) -> str:
        """Up to ``SKETCH`` smallest mixed window hashes, 8 hex digits each; a shorter text is one window, an empty one none."""
        if not self.n:
            return ""
        w = min(WINDOW, self.n)
        start = np.arange(self.n - w + 1)
        h = self.spans(start, start + w) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)
        if len(h) > 4 * SKETCH:
            few = h[h <= np.partition(h, SKETCH)[SKETCH]]  # repeated windows can leave fewer distinct ones
            h = few if len(np.unique(few)) >= SKETCH else h
        return "".join(f"{x:08x}" for x in np.unique(h)[:SKETCH])


def likeness(a: str, b: str) -> float:
    """0 to 1: of the smallest ``SKETCH`` hashes of both, the share that both have. Two empty fingerprints are alike."""
    x, y = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (a, b))
    if not x and not y:
        return 1.0
    both = sorted(x | y)[:SKETCH]
    return sum(h in x and h in y for h in both) / len(both)


def _row(doc_id, text: str, h: PrefixHash, fp: str, following: str, next_fp: str) -> tuple:
    cut = h.n // 4
    edited = text[: h.n - cut] + following[:cut]
    e = PrefixHash(edited)
    efp = e.fingerprint()
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest()
    return doc_id, h.n, sha, bytes.fromhex(fp), bytes.fromhex(efp), likeness(fp, efp), likeness(fp, next_fp), h.common_extension(0, 0, e)


_FIELDS = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, common_prefix long, part int, role string, text string"


def _neighbours(id_type):
    """Rows of one range partition in order: results where the next row is here, and the partition's ends with their texts."""

    def run(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                h = PrefixHash(text)
                fp = h.fingerprint()
                if before is None:
                    rows.append((None,) * 8 + (part, "head", text))
                else:
                    rows.append((*_row(*before, text, fp), part, "row", None))
                before = (doc_id.as_py(), text, h, fp)
            yield _batch(rows, id_type)
        if before is not None:
            yield _batch([(before[0],) + (None,) * 7 + (part, "tail", before[1])], id_type)

    return run


def _batch(rows, id_type):
    types = [id_type, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", *(f.split()[0] for f in _FIELDS.split(", "))])


def _ends(id_type):
    def run(batches):
        for batch in batches:
            rows = []
            for d, text, following in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h, after = PrefixHash(text or ""), PrefixHash(following or "")
                rows.append((*_row(d, text or "", h, h.fingerprint(), following or "", after.fingerprint()), None, "row", None))
            yield _batch(rows, id_type)

    return run


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document.

    The edited text has the last floor(n / 4) code points replaced by the first as many (or all) of the next document in
    ascending id, the last document's next being the first; a table of one row is its own next. A null text is empty;
    an empty text has an empty fingerprint, equal only to another empty one. Null ids come first and rows of one id are
    ordered by their text. Other columns are not read. An empty table gives no rows.

    Rows: ``(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_prefix)``,
    the last the code points that text and edited text share from the start, by binary search on the prefix hashes.

    A worker holds one text, its edited text and about ten arrays of 8 bytes for each of their code points. The texts move
    once, to range partitions, as many as the session's ``spark.sql.shuffle.partitions``; each partition's first and last row meet their neighbours in a join of
    one row a partition.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    text_batches(spark)
    id_kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(id_kind)
    schema = f"doc_id {id_kind.simpleString()}, {_FIELDS}"
    cut = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = cut.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    done = materialise(ordered.mapInArrow(_neighbours(id_type), schema))
    rows = done.where("role = 'row'")
    full = sorted(r[0] for r in done.where("role = 'head'").select("part").collect())  # one number a partition
    if full:
        after = spark.createDataFrame(list(zip(full, full[1:] + full[:1])), "part int, next int")
        head = done.where("role = 'head'").select(F.col("part").alias("next"), F.col("text").alias("following"))
        ends = done.where("role = 'tail'").join(F.broadcast(after), "part").join(head, "next").select("doc_id", "text", "following")
        rows = rows.unionByName(ends.mapInArrow(_ends(id_type), schema))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return rows.select(F.col("doc_id").alias(id_col), "n_chars", text("edited_sha256"), text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next", "common_prefix")
