"""Resolution of not-modified revisits in web captures (DataFrame functions only).

Each revisit is as-of joined, by canonical URL, to the latest earlier full response. The narrow
records (ids, URL, time, validators) are range-partitioned by URL, time and id and written with the
number of their range; the join then has two levels: within a range, and a carry of each range's
last response of a URL to the next ranges. A URL with a third of all captures, even in one burst,
spreads over as many ranges as its rows fill. Only narrow records travel through the windows;
headers and bodies are fetched by id for what resolved.

Outcomes: ``resolved`` (a validator agrees), ``unchecked`` (no validator is on both sides),
``mismatch`` (a validator differs; nothing is merged) and ``missing`` (no earlier response). The
entity tag decides before the modification date, that before the payload digest; a weak tag's
``W/`` is ignored. Merged headers are the response's, with those a 304 may update taken from the
revisit.

Defined cases: null URLs never match; null times sort first and have no earlier response; equal
times are ordered by record id; null headers are an empty map; header names are lower-cased (of
names that differ in case only, the one that sorts first wins); an empty table gives an empty
result; other columns are not looked at. Record ids name records: a repeated revisit gives a row
each, all with the outcome of the one with the latest response, and of responses that share an id
one is taken. A response without an id is not used and a revisit without one is ``missing``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stage, stage

#: Header fields a not-modified response may update.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")

URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:[?]([^#]*))?"


def canonical_url(url):
    """Host in lower case without ``www.``, no scheme, user, default port or fragment, sorted query."""
    part = lambda i: F.regexp_extract(url, URL, i)
    host = F.regexp_replace(F.lower(part(1)), "^www[.]", "")
    port = F.when(part(2).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), part(2)))
    path = F.when(part(3) == "", "/").otherwise(part(3))
    query = F.array_join(F.array_sort(F.array_remove(F.split(part(4), "&"), "")), "&")
    return F.when(url.isNotNull() & (host != ""), F.concat(host, port, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def _headers(h):
    low = F.transform(F.array_sort(F.map_entries(F.coalesce(h, F.create_map().cast("map<string,string>")))),
                      lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    first = F.filter(low, lambda e, i: F.array_position(F.transform(low, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(first)


def in_ranges(records: DataFrame) -> DataFrame:
    """Narrow records with ``part``, the number of the range of (URL, time, id) they lie in; written.

    They are written once before, as finding the ranges reads its input twice.
    """
    narrow = stage(records.where("url_key is not null"), "narrow")
    out = stage(narrow.repartitionByRange("url_key", "ts", "record_id").withColumn("part", F.spark_partition_id()), "captures")
    drop_stage(narrow)
    return out


def latest_earlier(ranged: DataFrame) -> DataFrame:
    """The revisits of the narrow records, each with ``at``: the validators of the latest earlier full response."""
    full = F.col("kind") == "response"
    own = F.when(full, F.struct("record_id", "ts", "etag", "last_modified", "digest"))
    order = Window.partitionBy("part", "url_key").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range of a URL: few, as a URL fills whole ranges but for its first and last.
    ends = ranged.groupBy("url_key", "part").agg(F.max_by(own, F.when(full, F.struct("ts", "record_id"))).alias("last"))
    carry = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    marks = ends.select(F.col("url_key").alias("u2"), F.col("part").alias("p2"), F.last("last", True).over(carry).alias("before"))
    inside = ranged.withColumn("near", F.last(own, True).over(order)).where(F.col("kind") == "revisit")
    return inside.join(marks, (F.col("url_key") == F.col("u2")) & (F.col("part") == F.col("p2"))).withColumn(
        "at", F.coalesce("near", "before")).drop("u2", "p2", "near", "before", "part")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row a revisit; records: record_id, url, ts (long), kind, status, etag, last_modified,
    digest, headers (map), body. A full response has kind ``response`` and status 200."""
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull()
    rows = records.where(full | (F.col("kind") == "revisit")).withColumn("url_key", canonical_url(F.col("url")))
    validators = ("etag", "last_modified", "digest")
    narrow = ("record_id", "url_key", "ts", "kind", *validators)
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    at = F.col("at")
    same = F.coalesce(tag(F.col("etag")) == tag(at["etag"]), F.col("last_modified") == at["last_modified"], F.col("digest") == at["digest"])
    outcome = F.when(at.isNull(), "missing").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("mismatch")
    found = stage(latest_earlier(in_ranges(rows.select(*narrow))).select(
        F.col("record_id").alias("r"), at["record_id"].alias("response_id"), at["ts"].alias("response_ts"), outcome.alias("outcome")).groupBy("r").agg(
        F.max(F.struct("response_id", "response_ts", "outcome")).alias("f")).select("r", "f.*"), "resolved")
    good = F.col("outcome").isin("resolved", "unchecked")
    wanted = found.where(good & F.col("response_id").isNotNull()).select(F.col("response_id").alias("w")).distinct()
    old = rows.where("kind = 'response'").select(F.col("record_id").alias("o"), F.col("headers").alias("o_headers"), F.col("body").alias("o_body"))
    old = old.join(wanted, F.col("o") == F.col("w"), "left_semi").groupBy("o").agg(F.min_by(F.struct("o_headers", "o_body"), F.xxhash64("o_body")).alias("old"))
    revisits = rows.where("kind = 'revisit'").select("record_id", "url_key", "ts", "headers")
    both = revisits.join(found, F.col("record_id") == F.col("r"), "left").withColumn(
        "outcome", F.coalesce("outcome", F.lit("missing"))).join(old, (F.col("response_id") == F.col("o")) & good, "left")
    merged = F.map_concat(
        F.map_filter(_headers(F.col("old.o_headers")), lambda k, v: ~(k.isin(*PERMITTED) & F.map_contains_key("new", k))),
        F.map_filter("new", lambda k, v: k.isin(*PERMITTED)))
    return both.withColumn("new", _headers(F.col("headers"))).select(
        "record_id", "url_key", "ts", "outcome", "response_id", "response_ts",
        F.when(good, merged).alias("headers"), F.when(good, F.col("old.o_body")).alias("body"))


def captures(pages: DataFrame) -> DataFrame:
    """A capture log from the page table: a response of every page, and a later revisit of its URL.

    The table has no revisits, so these are derived by rule from the page's own values: the time
    of the revisit and which validators it carries follow from digits of the URL's MD5 sum.
    """
    digit = lambda i: F.conv(F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), i, 2), 16, 10).cast("long")
    page = pages.select("page_id", "url", "html", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("sum"),
                        digit(1).alias("d1"), digit(3).alias("d2"))
    none = F.lit(None).cast("string")
    made = F.concat(F.lit("day "), F.expr("page_id div 7").cast("string"))
    response = page.select(
        (2 * F.col("page_id")).alias("record_id"), "url", (10 * F.col("page_id")).alias("ts"), F.lit("response").alias("kind"),
        F.lit(200).alias("status"), F.concat(F.lit('"'), "sum", F.lit('"')).alias("etag"), made.alias("last_modified"), F.col("sum").alias("digest"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), F.concat(F.lit('"'), "sum", F.lit('"')),
                     F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"), F.col("html").alias("body"))
    revisit = page.select(
        (2 * F.col("page_id") + 1).alias("record_id"), "url", (10 * F.col("page_id") + 5 + 10 * F.col("d1")).alias("ts"),
        F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.when(F.col("d2") % 4 < 2, F.concat(F.lit('W/"'), "sum", F.lit('"'))).alias("etag"),
        F.when(F.col("d2") % 4 == 2, made).alias("last_modified"), none.alias("digest"),
        F.create_map(F.lit("cache-control"), F.concat(F.lit("max-age="), F.col("d2").cast("string")), F.lit("Content-Type"), F.lit("text/plain")).alias("headers"),
        none.alias("body"))
    return response.unionAll(revisit)


def op7_revisits(spark, sf_dir):
    from .common import table

    out = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    return out.select(
        "record_id", "url_key", "ts", "outcome", "response_id",
        F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("headers"),
        F.md5(F.col("body").cast("binary")).alias("body_md5"))


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, url, html, md5(coalesce(html, '')) AS s, md5(coalesce(url, '')) AS u FROM pages),
q AS (SELECT *, CAST('0x' || substr(u, 1, 2) AS BIGINT) AS d1, CAST('0x' || substr(u, 3, 2) AS BIGINT) AS d2,
             'day ' || (page_id // 7) AS made,
             regexp_extract(url, '{URL}', ['h', 'o', 'p', 'q']) AS x FROM p),
c AS (SELECT *, CASE WHEN url IS NOT NULL AND regexp_replace(lower(x.h), '^www[.]', '') <> '' THEN
        regexp_replace(lower(x.h), '^www[.]', '') || CASE WHEN x.o IN ('', '80', '443') THEN '' ELSE ':' || x.o END
        || CASE WHEN x.p = '' THEN '/' ELSE x.p END
        || CASE WHEN len(list_filter(string_split(x.q, '&'), lambda y: y <> '')) = 0 THEN ''
                ELSE '?' || array_to_string(list_sort(list_filter(string_split(x.q, '&'), lambda y: y <> '')), '&') END END AS k FROM q),
r AS (SELECT 2 * page_id AS id, k, 10 * page_id AS ts, s, made, html FROM c),
v AS (SELECT 2 * page_id + 1 AS id, k, 10 * page_id + 5 + 10 * d1 AS ts, s, made, d2 FROM c),
j AS (SELECT v.id, v.k, v.ts, v.d2, v.s AS vs, v.made AS vm, r.id AS rid, r.s AS rs, r.made AS rm, r.html FROM v ASOF LEFT JOIN r ON v.k = r.k AND v.ts > r.ts),
o AS (SELECT *, CASE WHEN rid IS NULL THEN 'missing' WHEN d2 % 4 = 3 THEN 'unchecked'
        WHEN d2 % 4 = 2 THEN CASE WHEN vm = rm THEN 'resolved' ELSE 'mismatch' END
        WHEN vs = rs THEN 'resolved' ELSE 'mismatch' END AS outcome FROM j)
SELECT id AS record_id, k AS url_key, ts, outcome, rid AS response_id,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN 'cache-control=max-age=' || d2 || ';content-type=text/html;etag="' || rs || '"' END AS headers,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN md5(html) END AS body_md5
FROM o
""".replace("{URL}", URL)
