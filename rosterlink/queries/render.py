"""Inputs of the registered queries: pages and registry records rendered by Spark from the relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 5000  # customers a list page stands for, so that pages grow in number and not in size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(pages: DataFrame) -> DataFrame:
    """Pages over all cores, as files of stored pages would be: they are small here and their parsing is the work."""
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def u5_sql(namespace: str, key: str) -> str:
    """A name-based UUID in DuckDB SQL."""
    h = f"sha1(from_hex('{namespace.replace('-', '')}') || encode({key}))"
    return f"(SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||translate(substr(h,17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr(h,18,3)||'-'||substr(h,21,12) FROM (SELECT {h} AS h))"


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


NOTES = ["", "2001 nachgerückt", "Ausgeschieden wegen Parteiwechsel", "Fraktionswechsel", "Fraktionsaustritt, dann ausgeschieden", "krank"]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = c.withColumn("block", F.floor(F.col("c_custkey") / BLOCK).cast("int"))
    return c.withColumn("page_title", F.concat_ws("_", F.lit("Liste"), F.replace("n_name", F.lit(" "), F.lit("_")), F.col("block").cast("string")))


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One seed a list page; every fifth nation has no legislature number."""
    c = customers(spark, sf_dir).select("page_title", "n_nationkey", "n_name", "r_name", "block").distinct()
    return c.select(
        (F.col("n_nationkey") * 100000 + F.col("block")).cast("int").alias("seed_pos"), F.concat(F.lit("key_"), "page_title").alias("key"), "page_title", F.lit("2001-05-01").alias("expected_start"), F.lit("2005-04-30").alias("expected_end"),
        F.col("r_name").alias("parliament"), F.col("n_name").alias("state"), F.when(F.col("n_nationkey") % 5 == 4, 0).otherwise(F.col("n_nationkey") + 1).cast("int").alias("legislature_number"), F.array(F.lit("liste")).alias("section_keywords"),
    )


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member list for each nation and block: column order, decoys and headings vary by nation, every seventh row has no link."""
    c = customers(spark, sf_dir)
    k = F.col("c_custkey")
    link = F.concat(F.lit('<td><a href="/wiki/x" title="'), F.replace("c_name", F.lit("#"), F.lit(" ")), F.lit('">'), "c_name", F.lit("</a></td>"))
    name = F.when(k % 7 == 0, F.concat(F.lit("<td>"), "c_name", F.lit("</td>"))).otherwise(link)
    party = F.concat(F.lit("<td>"), escaped(F.col("c_mktsegment")), F.lit("\n</td>"))
    area = F.concat(F.lit("<td> "), "n_name", F.lit(" "), (k % 10).cast("string"), F.lit("</td>"))
    note = F.concat(F.lit("<td>"), F.element_at(F.array(*map(F.lit, NOTES)), (k % 6 + 1).cast("int")), F.lit("</td>"))
    kind = F.col("n_nationkey") % 3
    row = F.concat(F.lit("<tr>"), F.when(kind == 1, F.concat(party, name)).otherwise(F.concat(name, party)), area, note, F.lit("</tr>"))
    pages = c.select("page_title", "n_nationkey", "block", F.struct(k.alias("k"), row.alias("row")).alias("r")).groupBy("page_title", "n_nationkey", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]), "").alias("rows"))
    kind = F.col("n_nationkey") % 3
    head = F.when(kind == 0, "<tr><th>Name</th><th>Partei</th><th>Wahlkreis</th><th>Anmerkungen</th></tr>").when(kind == 1, "<tr><th>Fraktion</th><th>Name, Vorname</th><th>Wahlkreis</th><th>Bemerkung</th></tr>").otherwise("<tr><th>Abgeordnete</th><th>Partei</th><th>Wahlkreis</th><th>Notiz</th></tr>")
    before = F.when(kind == 1, '<table class="wikitable"><tr><th>Jahr</th><th>Wert</th></tr><tr><td>1</td><td>2</td></tr></table>').when(kind == 2, '<table class="wikitable"><tr><th>Jahr</th></tr></table><h2>Die Mitglieder</h2>').otherwise("<p>Koordinaten: 1<p>Text")
    html = F.concat(F.lit('<div class="mw-parser-output">'), before, F.lit('<table class="wikitable sortable">'), head, "rows", F.lit("</table></div><script>var t='<table></table>';</script>"))
    page_id = F.col("n_nationkey").cast("bigint") * 100000 + F.col("block") + 1
    return spread(pages).select("page_title", page_id.alias("page_id"), (page_id * 10).alias("revision_id"), html.alias("html"), F.sha2("page_title", 256).alias("sha256"), F.lit("2024-01-01T00:00:00Z").alias("retrieved_at"), F.concat(F.lit("https://de.wikipedia.org/wiki/"), "page_title").alias("url"))


def birth(k: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", 1950 + k % 50, k % 12 + 1, k % 28 + 1)


def person_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each customer, under another title where the balance is negative; dates as ``time``, as ``bday`` or not at all."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    date = birth(k)
    cell = F.when(k % 4 == 0, F.concat(F.lit('<time datetime="'), date, F.lit('">am</time>'))).when(k % 4 == 1, F.concat(F.lit('<span class="x bday">'), date, F.lit("</span>"))).otherwise(F.lit("unbekannt"))
    death = F.when(k % 5 == 0, F.concat(F.lit("<tr><th>Gestorben</th><td>"), (k % 28 + 1).cast("string"), F.lit(". März 2010</td></tr>"))).otherwise("")
    box = F.concat(F.lit('<table class="infobox vcard"><tr><th>Geboren</th><td>'), cell, F.lit("</td></tr>"), death, F.lit("</table>"))
    intro = F.concat(F.lit("<p>Koordinaten: 1 2</p><p>"), "c_name", F.lit(" gehört zu <b>"), escaped(F.col("c_mktsegment")), F.lit("</b>.[1]</p><p> Zweiter Absatz. </p>"))
    html = F.concat(F.lit('<div class="mw-parser-output">'), F.when(k % 11 == 0, "").otherwise(intro), box, F.lit("<p>Danach</p></div>"))
    title = F.concat(F.when(F.col("c_acctbal") < 0, "Andere_").otherwise(""), F.replace("c_name", F.lit("#"), F.lit("_")))
    return spread(c).select(title.alias("page_title"), (k + 10_000_000).alias("page_id"), (k + 20_000_000).alias("revision_id"), html.alias("html"), F.sha2("c_name", 256).alias("sha256"), F.lit("2024-02-02T00:00:00Z").alias("retrieved_at"), F.concat(F.lit("https://de.wikipedia.org/wiki/"), title).alias("url"))


def dip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry list pages of 100 persons from ``part``: first name, surname from the part's words, every ninth listed twice."""
    p = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    doc = F.struct(
        F.col("p_partkey").alias("id"), F.initcap(F.get(words, F.lit(0))).alias("vorname"), F.initcap(F.concat(F.get(words, F.lit(1)), (F.col("p_partkey") % 50).cast("string"))).alias("nachname"), F.lit(None).cast("string").alias("namenszusatz"),
        F.lit(None).cast("string").alias("titel"), F.array(F.col("p_brand")).alias("fraktion"), F.array((F.col("p_partkey") % 20 + 1).cast("int"), (F.col("p_partkey") % 20 + 2).cast("int")).alias("wahlperiode"),
        F.array().cast("array<map<string,string>>").alias("person_roles"),
    )
    once = p.select(F.lit(1).alias("wp"), F.floor(F.col("p_partkey") / 100).cast("int").alias("page"), doc.alias("d"))
    again = p.where("p_partkey % 9 = 0").select(F.lit(2).alias("wp"), F.floor(F.col("p_partkey") / 100).cast("int").alias("page"), doc.alias("d"))
    pages = once.unionByName(again).groupBy("wp", "page").agg(F.array_sort(F.collect_list("d"), lambda a, b: (a["id"] - b["id"]).cast("int")).alias("documents"))
    return pages


def wiki_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to link, from ``part``: the persons of the registry, some under another spelling."""
    p = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    first = F.initcap(F.get(words, F.lit(0)))
    last = F.initcap(F.concat(F.get(words, F.lit(1)), (F.col("p_partkey") % 50).cast("string")))
    name = F.when(F.col("p_partkey") % 10 == 3, F.concat(F.lit("Zz "), last)).when(F.col("p_partkey") % 10 == 6, F.concat(first, F.lit(" Nobody"))).otherwise(F.concat_ws(" ", first, last))
    title = F.concat(F.lit("Wiki_"), F.col("p_partkey").cast("string"))
    return p.select(F.concat(F.lit("w"), F.col("p_partkey").cast("string")).alias("id"), title.alias("wikipedia_title"), name.alias("name"), F.col("p_partkey").alias("page_id"), F.array(F.concat(F.lit("e"), F.col("p_partkey").cast("string"))).alias("evidence_ids"))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An override for every 100th part: accepted, rejected, to nobody of the registry, or without a person."""
    p = table(spark, sf_dir, "part").where("p_partkey % 100 = 0")
    k = F.col("p_partkey")
    who = F.when(k % 400 == 200, -1).when(k % 400 == 300, F.lit(None)).otherwise(k)
    return p.select(F.concat(F.lit("Wiki_"), k.cast("string")).alias("wikipedia_title"), who.cast("bigint").alias("dip_person_id"), F.when(k % 800 == 100, "rejected").otherwise("accepted").alias("status"), F.lit(None).cast("string").alias("reason"))
