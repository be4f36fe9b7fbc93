"""Text, date and URL expressions, and the two string helpers that need Python's Unicode tables or JSON writer."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlink.functions.ids import bound, strip

#: Where pages, and revisions of pages, are served.
BASE_URL = "https://de.wikipedia.org/wiki/"
REVISION_URL = "https://de.wikipedia.org/w/index.php?title="
#: German month names and abbreviations.
MONTHS = ["januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"]


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_header(text: Column) -> Column:
    return collapse(F.lower(text))


def underscored(title: Column) -> Column:
    return F.replace(title, F.lit(" "), F.lit("_"))


def safe_title(title: Column) -> Column:
    """A title as a path part; different titles may collide."""
    return F.regexp_replace(F.regexp_replace(title, r"[^A-Za-z0-9_-]", "_"), r"^_+|_+$", "")


def key_title(title: Column) -> Column:
    return F.translate(title, " /", "__")


def legislature_number(title: Column, snippet: Column) -> Column:
    """From ``(17. Wahlperiode)`` in the title, else in the snippet; 0 counts as missing."""
    def number(c: Column) -> Column:
        return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"\((\d+)\.\s*Wahlperiode\)", 1), F.lit("")).try_cast("int")

    return F.nullif(F.coalesce(F.nullif(number(title), F.lit(0)), number(snippet)), F.lit(0))


def clean_snippet(text: Column) -> Column:
    """Without ``[n]`` footnote marks, white space collapsed."""
    return collapse(F.regexp_replace(text, r"\[\d+\]", ""))


def truncate(text: Column, size: int) -> Column:
    """At the last space before ``size``, with an ellipsis; a hard cut where there is no space."""
    cut = lambda t: F.concat(F.regexp_replace(F.substring(t, 1, size), r"(?s) [^ ]*$", ""), F.lit("..."))
    return bound(text, lambda t: F.when(F.length(t) > size, cut(t)).otherwise(t))


def parse_date(text: Column) -> Column:
    """ISO, ``d.M.yyyy`` or ``d. Monat yyyy`` to an ISO string, else null."""
    spelled = r"^(\d{1,2})\.\s*(\p{L}+)\.?\s+(\d{4})$"
    months = F.array(*map(F.lit, MONTHS))

    def of_name(t: Column) -> Column:
        def date(named: Column) -> Column:
            # of no name, or a short one, there is no month; names that begin like a month are that one
            month = F.when(F.length(named) >= 3, F.nullif(F.array_position(F.transform(months, lambda m: m.startswith(named)), F.lit(True)), F.lit(0)))
            return bound(month, lambda m: F.when(m.isNotNull(), F.try_to_date(F.concat_ws("-", F.regexp_extract(t, spelled, 3), m.cast("string"), F.regexp_extract(t, spelled, 1)), "yyyy-M-d")))

        return bound(F.regexp_extract(t, spelled, 2), date)

    def date(t: Column) -> Column:
        plain = F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d"))
        dotted = F.when(t.rlike(r"^\d{1,2}\.\s*\d{1,2}\.\s*\d{4}$"), F.try_to_date(F.regexp_replace(t, r"\s", ""), "d.M.yyyy"))
        return F.when(t != "", F.date_format(F.coalesce(plain, dotted, of_name(F.lower(t))), "yyyy-MM-dd"))

    return bound(strip(F.coalesce(text, F.lit(""))), date)


def quote(text: Column) -> Column:
    """Percent-encoding of all but letters, digits and ``_.-~``."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def page_url(title: Column, revision: Column) -> Column:
    """The URL of a page revision as provenance has it; without a revision that of the page."""
    url = F.concat(F.lit(BASE_URL), quote(F.replace(title, F.lit("_"), F.lit(" "))))
    return F.when(revision > 0, F.concat(url, F.lit("?oldid="), revision.cast("string"))).otherwise(url)


def revision_url(title: Column, revision: Column) -> Column:
    """The canonical URL of a page revision, by its title and number as parameters; without a revision that of the page."""
    name = quote(F.replace(title, F.lit("_"), F.lit(" ")))
    return F.when(revision > 0, F.concat(F.lit(REVISION_URL), name, F.lit("&oldid="), revision.cast("string"))).otherwise(F.concat(F.lit(BASE_URL), name))


def form_encode(text: Column) -> Column:
    """Percent-encoding of a form value: like ``quote``, a space is ``+``."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def registry_url(base: Column, endpoint: Column, params: Column) -> Column:
    """base/endpoint?k=v for a ``map<string, array<string>>`` of parameters in the map's order, lists repeated."""
    each = F.flatten(F.transform(F.map_entries(params), lambda e: F.transform(e["value"], lambda v: F.concat(form_encode(e["key"]), F.lit("="), form_encode(v)))))
    url = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(endpoint, "^/+", ""))
    return F.when(F.size(each) > 0, F.concat(url, F.lit("?"), F.array_join(each, "&"))).otherwise(url)


def normalize_url(url: Column) -> Column:
    """A URL with its path and query encoded again.

    In the query, blank values go and the values of a repeated key stand together where the key first appears. A ``%`` in
    the path is encoded again. What does not begin with ``http`` is only encoded where it must be; null is empty.
    """
    url = F.coalesce(url, F.lit(""))
    part = lambda pattern: F.regexp_extract(url, r"(?s)^([^:/?#]+://[^/?#]*)([^?#]*)\??([^#]*)(#.*)?$", pattern)
    params = F.regexp_extract(part(2), r"(?s)(;[^/]*)$", 1)
    path = F.replace(quote(F.regexp_replace(part(2), r"(?s);[^/]*$", "")), F.lit("%2F"), F.lit("/"))
    decoded = lambda c: F.coalesce(F.try_url_decode(c), c)
    pairs = F.transform(
        F.filter(F.split(part(3), "&"), lambda p: p.rlike("(?s)^[^=]*=.+")),
        lambda p: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), decoded(F.regexp_replace(p, "(?s)^[^=]*=", "")).alias("v")),
    )
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    grouped = F.flatten(F.transform(keys, lambda k: F.filter(pairs, lambda p: p["k"] == k)))
    query = F.array_join(F.transform(grouped, lambda p: F.concat(form_encode(p["k"]), F.lit("="), form_encode(p["v"]))), "&")
    full = F.concat(part(1), path, params, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(F.length(part(4)) > 1, part(4)).otherwise(""))
    other = quote(url)
    for c in "/:?#[]@!$&'()*+,;=":
        other = F.replace(other, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.when(url.startswith("http") & url.contains("://"), full).otherwise(other)


@F.pandas_udf(T.StringType())
def normalize_name(names: pd.Series) -> pd.Series:
    """Lower case, stripped, white space collapsed, NFKD, then only word characters and spaces."""
    s = names.str.lower().str.strip().str.replace(r"\s+", " ", regex=True).str.normalize("NFKD")
    return s.str.replace(r"[^\w\s]", "", regex=True)


def fold_umlauts(text: Column) -> Column:
    #: The folding of umlauts.
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def name_parts(name: Column) -> Column:
    """``struct(first, last, middle)``: first and last token and what is between; one token is a first name."""
    t = F.filter(F.split(name, r"(?U)\s+"), lambda x: x != "")
    n = F.size(t)
    last = F.when(n > 1, F.element_at(t, -1)).otherwise("")
    middle = F.when(n > 2, F.array_join(F.slice(t, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).otherwise("")
    return F.struct(F.coalesce(F.get(t, F.lit(0)), F.lit("")).alias("first"), last.alias("last"), middle.alias("middle"))


@F.pandas_udf(T.StringType())
def canonical_json_sha256(texts: pd.Series) -> pd.Series:
    """SHA-256 of a JSON text written again with sorted keys and non-ASCII characters as they are; null for invalid JSON."""
    def one(t):
        try:
            return hashlib.sha256(json.dumps(json.loads(t), sort_keys=True, ensure_ascii=False).encode()).hexdigest()
        except (TypeError, ValueError):
            return None

    return texts.map(one)


@F.pandas_udf(T.StructType([T.StructField("raw", T.StringType()), T.StructField("parse", T.StringType())]))
def response_sha256(texts: pd.Series) -> pd.DataFrame:
    """SHA-256 of a stored response and of its ``parse`` object, as ``canonical_json_sha256``; null for null or invalid JSON."""
    def one(t):
        try:
            whole = json.loads(t)
            return [hashlib.sha256(json.dumps(x, sort_keys=True, ensure_ascii=False).encode()).hexdigest() for x in (whole, whole.get("parse", {}))]
        except (AttributeError, TypeError, ValueError):
            return [None, None]

    return pd.DataFrame([one(t) for t in texts], columns=["raw", "parse"], index=texts.index, dtype=object)


def params_hash(texts: Column) -> Column:
    return F.substring(canonical_json_sha256(texts), 1, 16)
