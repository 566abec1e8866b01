"""Language identification by multilingual mixture inference.

Learning counts byte trigrams of all labelled training texts per language. For a document,
expectation-maximisation estimates the proportions of the languages from its trigrams'
likelihoods; the language set is chosen by penalised likelihood: languages are dropped while the
Bayesian information criterion improves, all of small share at once or, where that is refused,
one at a time, least share first.

Defined cases: null text or text without a letter is ``und`` with score 0 and no languages; so is
every text if nothing was learned; a letter is a character of a Unicode letter category, so digits,
fractions and superscripts are none; texts under three bytes are padded; a null id is not held out;
ties go to the language that sorts first; repeated rows are predicted alike; an empty table gives
an empty result; other columns stay, and where the input has a column ``language`` the new one is
named with an underscore after it. ``lang`` holds language codes: the model has ``BUCKETS`` numbers
for each distinct value, on the driver and in each task.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, give_back

BUCKETS = 1 << 16
WORDLIKE = re.compile(r"[^\W\d_]")
ROUNDS = 25


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in WORDLIKE.finditer(text))


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the lower-cased text, one blank around it."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, dtype=np.int64)
    x = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((x * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def learn(train: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log likelihoods [BUCKETS, languages]) from every row of ``train``.

    Each task adds up counts per language; what reaches the driver is at most BUCKETS numbers a
    language, however large the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        pending: dict[str, list] = defaultdict(list)

        def add():
            for lang, grams in pending.items():
                total[lang] = total.get(lang, 0) + np.bincount(np.concatenate(grams), minlength=BUCKETS)
            pending.clear()

        size = 0
        for batch in give_back(batches):
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                if text := text.as_py():
                    pending[lang.as_py()].append(trigrams(text))
                    size += len(text)
                if size > 16 * BUCKETS:
                    add()
                    size = 0
        add()
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["l", "bucket", "n"])

    counts = (
        train.where(F.col(lang).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"))
        .mapInArrow(run, "l string, bucket int, n long")
        .groupBy("l", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    langs = sorted(counts["l"].unique().tolist())
    table = np.zeros((BUCKETS, len(langs)))
    for j, name in enumerate(langs):
        own = counts[counts["l"] == name]
        table[own["bucket"].to_numpy(), j] = own["n"].to_numpy()
    smooth = table + 0.5
    return langs, np.log(smooth / smooth.sum(axis=0)).astype(np.float32) if langs else table


def _em(like: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    pi, total, mix = start, n.sum(), like @ start
    for _ in range(ROUNDS):
        new = pi * (like.T @ (n / mix)) / total
        mix = like @ new
        if np.abs(new - pi).max() < 1e-3:
            pi = new
            break
        pi = new
    return pi, float(n @ np.log(mix))


def mixture(text: str, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes of the chosen languages, their proportions), largest first."""
    grams = trigrams(text)
    at, n = np.unique(grams, return_counts=True)
    n = n.astype(np.float64)
    part = logp[at]
    top = part.max(axis=1, keepdims=True)
    like, base = np.exp((part - top).astype(np.float64)), float(n @ top[:, 0])
    live = np.arange(logp.shape[1])
    pi, fit = _em(like, n, np.full(len(live), 1 / len(live)))
    penalty = 0.5 * np.log(max(2.0, n.sum()))
    while len(live) > 1:
        rest = pi > 0.02
        rest[np.argmin(pi)] = False
        if not rest.any():
            rest[np.argmax(pi)] = True
        singles = (np.arange(len(live)) != i for i in np.argsort(pi, kind="stable"))
        for rest in itertools.chain([rest], singles):
            now, less = _em(like[:, rest], n, pi[rest] / pi[rest].sum())
            if less + penalty * (len(live) - rest.sum()) >= fit:
                break
        else:
            break
        live, like, pi, fit = live[rest], like[:, rest], now, less
    order = np.lexsort((live, -pi))
    return live[order], pi[order]


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """Add ``language``: struct(lang, score, langs, shares); the input's columns stay."""
    langs, logp = model
    held = docs.sparkSession.sparkContext.broadcast(logp)  # BUCKETS x languages

    kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))

    @F.arrow_udf("struct<lang: string, score: double, langs: array<string>, shares: array<double>>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in give_back(texts):
            out = []
            for t in s:
                t = t.as_py()
                if not langs or not t or not has_letter(t):
                    out.append(("und", 0.0, [], []))
                    continue
                who, pi = mixture(t, held.value)
                names = [langs[i] for i in who]
                out.append((names[0], float(min(1.0, pi[0])), names, pi.tolist()))
            yield pa.StructArray.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["lang", "score", "langs", "shares"])

    return docs.select("*", run(F.col(text)).alias(free(docs, "language")))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op5_language_mixture(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    x = F.col("language")
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).select(
        "doc_id", "held_out", x["lang"].alias("lang_pred"), x["score"].alias("score"),
        x["langs"].alias("langs"), x["shares"].alias("shares"))
