"""Secret scans with multipart credential linking (DataFrame and SQL functions only).

Base kinds stand on their own: ``assign``, ``access`` and ``hex``. Weak kinds are parts that
mean little alone: ``ident`` (a user or client name assigned), ``weak`` (a long random-looking
token) and ``endpoint`` (a service address). Each weak part is interval-joined with its
document's other parts: scopes are ``SCOPE`` code points to either side of a whole part, cut into
bins, and the join is an equi-join on document and bin with the distance as a condition; a part
stands in every bin that it covers. It is a semi-join, so no pair is ever built and a bin holds at
most ``SCOPE`` parts of a kind. A weak token is reported when an
identifier is in scope, an identifier when a secret is, an endpoint when both are.

Spans are [start, end) in code points of the whole text.

Defined cases: null or empty text has no span; rows that repeat give the same spans each; a null
id is an id like others; a weak token that overlaps a base span is that span, not a part of its
own; an empty table gives an empty result; the input's columns stay, whatever their names, and where
one is called ``secrets`` the new column is named with an underscore after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, stage

SCOPE = 400
REDACTED = "[REDACTED]"

#: Kind, pattern, group whose length counts, least length. In span order.
KINDS = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("ident", r"(?i:client_?id|access_?key_?id|account_?id|user_?name|user|login)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?[A-Za-z0-9@._-]+", 0, 8),
    ("weak", r"[A-Za-z0-9+/]{32,}", 0, 32),
    ("endpoint", r"(?:https?|postgresql|postgres|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9][^\x00-\x20\x22\x27<>]*", 0, 8),
)
BASE = 3
SPAN = "array<struct<start: int, end: int>>"


def _spans(text: str, pattern: str, group: int, least: int) -> str:
    """SQL for the spans of the leftmost non-overlapping matches that are long enough.

    The text between matches comes from a split at the same pattern; running lengths give places.
    """
    re = f"r'{pattern}'"
    size = f"transform(regexp_extract_all({text}, {re}, {group}), x -> length(x))"
    return f"""CASE WHEN {text} RLIKE {re} THEN aggregate(
      arrays_zip(transform(split({text}, {re}, -1), x -> length(x)),
                 transform(regexp_extract_all({text}, {re}, 0), x -> length(x)), {size}),
      struct(0 AS at, CAST(array() AS {SPAN}) AS spans),
      (acc, x) -> struct(acc.at + x['0'] + coalesce(x['1'], 0) AS at,
        CASE WHEN x['2'] >= {least}
             THEN concat(acc.spans, array(struct(acc.at + x['0'] AS start, acc.at + x['0'] + x['1'] AS end)))
             ELSE acc.spans END AS spans)).spans
      ELSE CAST(array() AS {SPAN}) END"""


def with_parts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Add ``__<kind>`` span arrays and ``__row``, a hash of id and text."""
    out = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    for kind, pattern, group, least in KINDS:
        out = out.withColumn(f"__{kind}", F.expr(_spans("__t", pattern, group, least)))
    clear = "filter(__weak, w -> NOT exists(concat(__assign, __access, __hex), b -> b.start < w.end AND w.start < b.end))"
    return out.withColumn("__weak", F.expr(clear)).withColumn("__row", F.xxhash64(F.col(key), "__t")).drop("__t")


def _linked(parts: DataFrame) -> DataFrame:
    """(__key, __row, added): weak spans with their complements in scope; parts: narrow rows."""
    flat = parts.where("size(__ident) + size(__weak) + size(__endpoint) > 0").select("__key", "__row", F.explode(F.expr(
        "concat(" + ", ".join(f"transform(__{k}, x -> struct('{k}' AS kind, {i} AS rank, x.start AS start, x.end AS end))"
                              for i, (k, *_) in enumerate(KINDS)) + ")")).alias("p")).select("__key", "__row", "p.*").distinct()
    def in_scope(left, roles):
        near = flat.where(F.col("kind").isin(*roles)).select(
            F.col("__key").alias("k2"), F.col("__row").alias("r2"), F.col("start").alias("s2"), F.col("end").alias("e2"),
            F.explode(F.sequence(F.expr(f"greatest(start - {SCOPE}, 0) div {SCOPE}"), F.expr(f"(end + {SCOPE}) div {SCOPE}"))).alias("b2"))
        covered = left.withColumn("bin", F.explode(F.sequence(F.expr(f"start div {SCOPE}"), F.expr(f"end div {SCOPE}"))))
        return covered.join(near, (F.col("__row") == F.col("r2")) & F.col("__key").eqNullSafe(F.col("k2")) & (F.col("bin") == F.col("b2"))
                         & (F.col("end") >= F.col("s2") - SCOPE) & (F.col("start") <= F.col("e2") + SCOPE), "left_semi").drop("bin").distinct()

    identifiers, secrets = ("access", "ident"), ("assign", "hex", "weak")
    kind = lambda k: flat.where(F.col("kind") == k)
    found = in_scope(kind("weak"), identifiers).unionAll(in_scope(kind("ident"), secrets)).unionAll(
        in_scope(in_scope(kind("endpoint"), identifiers), secrets))
    return found.groupBy("__key", "__row").agg(F.collect_list(F.struct("start", "rank", "end", "kind")).alias("added"))


def _all_spans(base_only: bool = False):
    kinds = KINDS[:BASE]
    base = "concat(" + ", ".join(
        f"transform(__{k}, x -> struct(x.start AS start, {i} AS rank, x.end AS end, '{k}' AS kind))" for i, (k, *_) in enumerate(kinds)) + ")"
    return F.expr(f"array_sort({base})" if base_only else f"array_sort(concat({base}, coalesce(added, array())))")


def _scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(all, t, secrets): each input row as a struct, its text and its spans.

    The patterns run once: rows and spans are written together. Texts are not shuffled but for
    the few rows with a weak part, which meet their links.
    """
    packed = docs.select(F.struct("*").alias("all"), F.col(key).alias("__key"), F.col(text).cast("string").alias("t"))
    parts = stage(with_parts(packed, "__key", "t"), "parts")
    weak = "size(__ident) + size(__weak) + size(__endpoint) > 0"
    mine = [f"__{k}" for k, *_ in KINDS] + ["__row", "__key"]
    links = _linked(parts.where(weak).select(*mine)).select(F.col("__key").alias("__k2"), F.col("__row").alias("__r2"), "added")
    straight = parts.where(f"NOT ({weak})").withColumn("secrets", _all_spans(base_only=True))
    joined = parts.where(weak).join(
        links, (F.col("__row") == F.col("__r2")) & F.col("__key").eqNullSafe(F.col("__k2")), "left").withColumn("secrets", _all_spans())
    return straight.select("all", "t", "secrets").unionByName(joined.select("all", "t", "secrets"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with ``secrets``: array of (start, rank, end, kind), sorted."""
    return _scanned(docs, key, text).select("all.*", F.col("secrets").alias(free(docs, "secrets")))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with every span replaced in the text; a length column follows. Columns stay."""
    cut = F.expr(f"""aggregate(secrets, struct(0 AS at, CAST(array() AS array<string>) AS o), (acc, x) -> struct(
        greatest(acc.at, x.end) AS at,
        CASE WHEN x.start >= acc.at
             THEN concat(acc.o, array(substring(t, acc.at + 1, x.start - acc.at), '{REDACTED}')) ELSE acc.o END AS o),
        acc -> CASE WHEN size(acc.o) = 0 THEN t ELSE concat(array_join(acc.o, ''), substring(t, acc.at + 1)) END)""")
    out = _scanned(docs, key, text).select("all", (F.size("secrets") > 0).alias("found"), cut.alias("cut"))

    def column(name):
        own = F.col("all")[name]
        if name == text:
            return F.when(F.col("found"), F.col("cut")).otherwise(own).alias(name)
        if name == n_chars:
            return F.when(F.col("found"), F.length("cut").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return out.select(*map(column, docs.columns))


def op3_multipart_secrets(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The patterns run once; what is written is spans only.
    parts = stage(with_parts(docs, "doc_id", "text").drop("text").withColumn("__key", F.col("doc_id")), "op3")
    links = _linked(parts).select(F.col("__key").alias("__k2"), F.col("__row").alias("__r2"), "added")
    show = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return (
        parts.join(links, (F.col("__row") == F.col("__r2")) & F.col("__key").eqNullSafe(F.col("__k2")), "left")
        .select(
            "doc_id",
            *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k, *_ in KINDS[:BASE]],
            F.sha2(show(_all_spans(base_only=True)), 256).alias("base_sha256"),
            show(_all_spans()).alias("spans"),
        )
    )


OP3_SQL = r"""
WITH k(kind, rank, re, grp, least) AS (VALUES """ + ", ".join(
    f"('{k}', {i}, '{p}', {g}, {n})" for i, (k, p, g, n) in enumerate(KINDS)) + r"""),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, kind, rank, least, list_transform(string_split_regex(t, re), lambda x: length(x)) AS g,
             list_transform(regexp_extract_all(t, re, 0), lambda x: length(x)) AS m,
             list_transform(CASE WHEN grp = 2 THEN regexp_extract_all(t, re, 2) ELSE regexp_extract_all(t, re, 0) END, lambda x: length(x)) AS c
      FROM d, k WHERE regexp_matches(t, re)),
s AS (SELECT doc_id, kind, rank, least, g[i] AS g, m[i] AS m, c[i] AS c, i,
             sum(g[i] + m[i]) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m)),
p0 AS (SELECT doc_id, kind, rank, CAST(e - m AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM s WHERE c >= least),
p AS (SELECT * FROM p0 a WHERE kind <> 'weak' OR NOT EXISTS (
        SELECT 1 FROM p0 b WHERE b.doc_id = a.doc_id AND b.rank < 3 AND b.s < a.e AND a.s < b.e)),
x AS (SELECT *, EXISTS (SELECT 1 FROM p b WHERE b.doc_id = a.doc_id AND b.kind IN ('access', 'ident') AND a.e >= b.s - 400 AND a.s <= b.e + 400) AS near_id,
             EXISTS (SELECT 1 FROM p b WHERE b.doc_id = a.doc_id AND b.kind IN ('assign', 'hex', 'weak') AND a.e >= b.s - 400 AND a.s <= b.e + 400) AS near_secret
      FROM p a),
r AS (SELECT * FROM x WHERE rank < 3 OR (kind = 'weak' AND near_id) OR (kind = 'ident' AND near_secret) OR (kind = 'endpoint' AND near_id AND near_secret)),
o AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS b,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS a FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans FROM d LEFT JOIN o USING (doc_id)
"""
