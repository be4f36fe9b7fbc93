"""Records of the federal person registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlink.functions.ids import dip_record_id, evidence_id
from rosterlink.functions.text import canonical_json_sha256
from rosterlink.sources.readers import per_wp


def dedup_dip(persons: DataFrame) -> DataFrame:
    """One row a person: values of the first place, the terms of all rows."""
    rest = [c for c in persons.columns if c not in ("dip_person_id", "wahlperiode")]
    rows = persons.groupBy("dip_person_id").agg(F.min_by(F.struct(*rest), "dip_pos").alias("v"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("wahlperiode")))).alias("wahlperiode"))
    return rows.select("dip_person_id", "v.*", "wahlperiode")


def count_per_wp(persons: DataFrame, first: int, last: int) -> DataFrame:
    return per_wp(persons, first, last).groupBy("wp").agg(F.count("*").alias("persons"))


def dip_records(persons: DataFrame) -> DataFrame:
    """Records with their id and a record-level evidence id over the canonical JSON of the person."""
    names = ["dip_person_id", "vorname", "nachname", "namenszusatz", "titel", "fraktion", "wahlperiode", "person_roles"]
    body = F.struct(F.col("dip_person_id").alias("id"), *names[1:])
    rows = persons.withColumn("sha256", canonical_json_sha256(F.to_json(body, {"ignoreNullFields": "false"})))
    ev = evidence_id(F.col("dip_person_id"), F.lit(0), F.lit("dip_person"), F.col("sha256"))
    return rows.select(dip_record_id(F.col("dip_person_id")).alias("id"), *names, "dip_pos", F.array(ev).alias("evidence_ids"))
