"""The training-data pipeline: five stages from documents to packed sequences, each over all that its predecessor kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; between stages it is written as Parquet and read
again. All but the last return the columns of ``documents``. Stages that drop rows decide on each row, whatever its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlink.llm.common import held_out, labelled_sample, materialise, table, without
from rosterlink.llm.decontamination import contaminated
from rosterlink.llm.ngram_join import ngram_jaccard_components
from rosterlink.llm.packing import pack, token_pieces
from rosterlink.llm.queries import vocabulary
from rosterlink.llm.secrets import redact, scan_secrets
from rosterlink.llm.toxicity import fit_lexicon, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.7 or more go.

    The lexicon is learned from the labelled rows that ``op3_toxicity`` may learn from. Null, empty and wordless texts
    stay; repeated rows, rows without an id and extra columns don't matter; a very long text is scored as a whole.
    """
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    return without_toxic(docs, fit_lexicon(labelled_sample(docs, labels, label_col="toxic")))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__row``, a key of the row itself, written once so that it stays the same."""
    return materialise(docs.withColumn("__row", F.monotonically_increasing_id()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked by five-word shingles at 0.8 or more, the one with the smallest id stays.

    Rows without an id come after those with one; of rows with one id the first stays. Rows without words (null and empty
    texts) stay, each of them. A row counts by itself, so different texts under one id are judged by themselves.
    """
    rows = keyed(docs)
    # the key orders rows as they are kept, so a component is named by the row of it that stays
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    groups = ngram_jaccard_components(rows.withColumn("__key", key), id_col="__key").where("n_shingles > 0")
    gone = groups.where("component_id.__row <> __key.__row").select(F.col("__key.__row").alias("__row"))
    return without(rows, gone, "__row").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item or a passage of one go, with or without an id.

    Null and empty texts stay. Rows that share an id are judged by themselves. An empty benchmark lets all rows stay.
    """
    rows = keyed(docs)
    return without(rows, contaminated(rows, table(spark, sf_dir, "benchmark"), id_col="__row"), "__row").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts and ``n_chars`` counts what is left (null for a null text); every row stays.

    Repeated rows and rows without an id are masked like any other.
    """
    out = redact(docs, scan_secrets(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are tokenised and packed into sequences of at most 2048 tokens; a null or empty text is its end alone.

    Repeated rows and rows without an id have their own pieces; a very long text is cut into several.
    """
    return pack(token_pieces(docs, vocabulary()))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
    return docs


#: Trained models, components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
