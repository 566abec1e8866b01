"""Quality rules at document and host level (DataFrame functions only).

A document fails when it has fewer than ``min_words`` words, or when more than half of its
words lie in repeated three-word windows. Failures are aggregated by host, each host's rate
is shrunk with a beta prior fitted to all hosts by the method of moments, and the verdict is
joined back to the documents.

Defined cases: a null text counts as empty (0 words, failed); a null host forms a host of its
own; repeated rows count each time; an empty table gives an empty result; the input's columns stay,
and where it has a column of a new one's name (``rules``, ``host_rules``, ``kept``) the new one is
named with an underscore after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, join_hot, let, stage, words_of

#: Characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"


def _repeated(words):
    """Words inside three-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash. The hash array is deduplicated first; only a text
    with a duplicate is sorted, so the common case is linear.
    """

    def hashes(w):
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
        )

    def positions(h):
        tagged = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(tagged, lambda s: F.array_sort(F.transform(
            F.filter(
                F.transform(s, lambda x, k: F.struct(
                    x["i"].alias("i"),
                    (F.get(s, k - 1)["h"].eqNullSafe(x["h"])
                     | F.get(s, k + 1)["h"].eqNullSafe(x["h"])).alias("twice"),
                )),
                lambda x: x["twice"],
            ),
            lambda x: x["i"],
        )))

    def covered(h):
        return let(positions(h), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0), lambda acc, x: acc + x,
        ))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(hashes(words), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)
        ).otherwise(covered(h)))
    )


def document_rules(docs: DataFrame, text: str = "text", min_words: int = 50) -> DataFrame:
    """Add a struct ``rules`` with the measures and the verdict of each document."""
    judged = _judged(docs.select(F.struct("*").alias("all"), F.col(text).cast("string").alias("t")), min_words)
    return judged.select("all.*", F.col("rules").alias(free(docs, "rules")))


def _judged(docs: DataFrame, min_words: int, text: str = "t") -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    measures = let(words_of(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated(w).cast("long").alias("n_repeat_words"),
    ))
    out = docs.withColumn("rules", F.struct(
        measures.alias("m"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    m = F.col("rules.m")
    failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return out.withColumn("rules", F.struct(
        m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
        F.col("rules.n_symbols").alias("n_symbols"), F.col("rules.n_dup_lines").alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"),
    ))


def host_verdicts(judged: DataFrame, host: str, failed: str, max_rate: float = 0.5) -> DataFrame:
    """Per host: n, failures, raw and shrunk rate, and ``host_ok``.

    The beta prior's mean is the mean of the host rates; its strength follows from their
    variance after the binomial part is taken off (method of moments), within 1 to 10,000.
    Its parameters come from one aggregate over hosts: counts are pre-aggregated per task,
    so a hot host is one row per task.
    """
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("n_failed")
    ).withColumn("rate", F.col("n_failed") / F.col("n"))
    prior = hosts.agg(
        F.avg("rate").alias("mu"), F.var_pop("rate").alias("var"), F.avg(1 / F.col("n")).alias("inv_n")
    )
    spread = F.col("mu") * (1 - F.col("mu"))
    excess = F.col("var") - spread * F.col("inv_n")
    strength = F.when(excess > 0, F.least(F.lit(1e4), F.greatest(F.lit(1.0), spread / excess - 1))).otherwise(F.lit(1e4))
    prior = prior.select("mu", strength.alias("strength"))
    return (
        hosts.join(F.broadcast(prior))  # one row
        .withColumn("shrunk_rate", (F.col("n_failed") + F.col("strength") * F.col("mu")) / (F.col("n") + F.col("strength")))
        .select("host", "n", "n_failed", "rate", "shrunk_rate", (F.col("shrunk_rate") <= max_rate).alias("host_ok"))
    )


def _host_key(host):
    """A key that is never null: a null host is a host of its own."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def _with_hosts(judged: DataFrame, host: str, max_rate: float) -> DataFrame:
    """Judged rows (with ``rules``) with ``n``, ``n_failed``, ``shrunk_rate`` and ``host_ok`` of their host.

    The host table is written: a hot host meets its rows by broadcast, the others in a shuffle.
    """
    hosts = stage(host_verdicts(judged.select(_host_key(F.col(host)).alias("h"), F.col("rules.base_failed").alias("f")), "h", "f", max_rate)
                  .select(F.col("host").alias("__host"), F.col("n").alias("rows"), "n", "n_failed", "shrunk_rate", "host_ok"), "hosts")
    keyed = judged.withColumn("__host", _host_key(F.col(host))).withColumn("__spread", F.monotonically_increasing_id())
    return join_hot(keyed, hosts, "__host", "rows", spread="__spread").drop("__host", "__spread")


def apply_host_rules(docs: DataFrame, text: str = "text", host: str = "source",
                     min_words: int = 50, max_rate: float = 0.5) -> DataFrame:
    """Documents with ``rules``, the host's verdict and ``kept``; other columns stay.

    The rules run twice, for the hosts and for the rows, rather than write every text once more.
    """
    packed = docs.select(F.struct("*").alias("all"), F.col(host).alias("h"), F.col(text).cast("string").alias("t"))
    out = _with_hosts(_judged(packed, min_words), "h", max_rate)
    return out.select(
        "all.*", F.col("rules").alias(free(docs, "rules")),
        F.struct("n", "n_failed", "shrunk_rate", "host_ok").alias(free(docs, "host_rules")),
        (~F.col("rules.base_failed") & F.col("host_ok")).alias(free(docs, "kept")))


def op8_host_rules(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # The measures are needed twice (host aggregate, join back): they are written once, narrow.
    judged = stage(_judged(docs, 50, "text").select("doc_id", "source", "rules"), "op8")
    return _with_hosts(judged, "source", 0.5).select(
        "doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines",
        "rules.n_repeat_words", "rules.base_failed", (~F.col("rules.base_failed") & F.col("host_ok")).alias("kept"))


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, w, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
ln AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
m AS (
  SELECT w.doc_id, w.source, CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ln.l) - len(list_distinct(ln.l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS k, sum(base_failed::INT) / count(*) AS r FROM f GROUP BY source),
p AS (SELECT avg(r) AS mu, var_pop(r) AS v, avg(1.0::DOUBLE / n) AS inv FROM h),
s AS (SELECT mu, CASE WHEN v - mu * (1 - mu) * inv > 0
        THEN least(1e4, greatest(1.0, mu * (1 - mu) / (v - mu * (1 - mu) * inv) - 1)) ELSE 1e4 END AS st FROM p)
SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed,
       (NOT f.base_failed AND (h.k + s.st * s.mu) / (h.n + s.st) <= 0.5) AS kept
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source, s
"""
