"""Deterministic ids: name-based UUIDs (version 5) as plain SQL expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespaces of the kinds of ids.
PERSON = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
LEGISLATURE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
PARTY = "6ba7b812-9dad-11d1-80b4-00c04fd430c8"
MANDATE = "6ba7b813-9dad-11d1-80b4-00c04fd430c8"
EVIDENCE = "6ba7b814-9dad-11d1-80b4-00c04fd430c8"


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that it uses several times: a lambda binds it, so that it is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def uuid5(namespace: str, key: Column) -> Column:
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(key, "UTF-8")))

    def shaped(h: Column) -> Column:
        variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab" * 4)
        return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))

    return bound(digest, shaped)


def strip(text: Column) -> Column:
    """Without white space (Unicode) at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def person_id(title: Column) -> Column:
    return uuid5(PERSON, strip(F.lower(title)))


def legislature_id(parliament: Column, state: Column, number: Column) -> Column:
    return uuid5(LEGISLATURE, F.concat_ws("|", parliament, state, number.cast("string")))


def party_id(name: Column) -> Column:
    return uuid5(PARTY, F.lower(strip(name)))


def mandate_id(person: Column, legislature: Column, start: Column, end: Column, role: Column) -> Column:
    """Missing (null or empty) parts but the person and the role count as ``unknown``."""
    parts = [F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown")) for c in (legislature, start, end)]
    return uuid5(MANDATE, F.concat_ws("|", person, *parts, role))


def evidence_id(page_id: Column, revision_id: Column, endpoint_kind: Column, sha256: Column) -> Column:
    return uuid5(EVIDENCE, F.concat_ws("|", page_id.cast("string"), revision_id.cast("string"), endpoint_kind, sha256))


def dip_record_id(dip_person_id: Column) -> Column:
    return uuid5(PERSON, F.concat(F.lit("dip:"), dip_person_id.cast("string")))


def canonical_id(title: Column, dip_person_id: Column) -> Column:
    return uuid5(PERSON, F.when(F.length(title) > 0, F.concat(F.lit("wikipedia:"), F.lower(title))).otherwise(F.concat(F.lit("dip:"), dip_person_id.cast("string"))))


def link_assertion_id(wikipedia_ref: Column, dip_ref: Column, ruleset: str) -> Column:
    return uuid5(PERSON, F.concat_ws("|", wikipedia_ref, dip_ref, F.lit(ruleset)))
