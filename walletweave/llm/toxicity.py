"""Toxicity with a classifier chain.

The categories are predicted one after the other: each later linear model sees the words, their
stems and the earlier categories' probabilities. For its training these are out-of-fold predictions, so a
later model learns from probabilities as unsure as those it meets on new documents.

Training uses a bounded sample of labelled ids (``max_rows``, taken by a hash of the id, so it
does not depend on partitioning) and one text of each; equal texts share a fold. Every document is
scored on its whole text.

Defined cases: null, empty or wordless text has probability 0 in every category; a null label is
no label; repeated label rows count once, the larger value wins; without labels or with one class
only, a category's probability is its observed share; rows with one id are all scored, and one of
their texts, that of the least hash, stands for the id in training; an empty table gives an empty
result; other columns stay, and where the input has a column ``toxicity`` the new one is named with
an underscore after it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stage, free, give_back, stage

WORD = re.compile(r"\w+")
STEMS = (3, 4, 5, 6)
FOLDS = 5
MAX_ROWS = 12_000
MAX_FEATURES = 128

#: Chain order: (category, SQL over the label table that gives 0 or 1).
CATEGORIES = (("low_quality", "1 - quality"), ("toxic", "toxic"))


def word_set(text: str | None) -> set[str]:
    """The words of the whole text, and their stems: the first 3 to 6 letters, marked by a star."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words | {w[:k] + "*" for k in STEMS for w in words if len(w) > k}


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the intercept."""
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    a = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + np.diag(keep), a.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _prob(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, categories, max_rows: int) -> DataFrame:
    """(k, fold, words, category columns) of at most about ``max_rows`` labelled documents, one row an id."""
    names = [n for n, _ in categories]
    known = labels.select(F.col(key).alias("k"), *[F.expr(e).cast("int").alias(n) for n, e in categories])
    known = known.where("k is not null").groupBy("k").agg(*[F.max(n).alias(n) for n in names]).dropna(subset=names)
    total = max(1, known.count())
    share = min(1.0, max_rows / total)
    known = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1)).limit(2 * max_rows)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(known), "k")  # bounded by max_rows
    one = rows.groupBy("k", *names).agg(F.min_by("t", F.xxhash64("t")).alias("t"))

    @F.arrow_udf("array<string>")
    def all_words(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(word_set(t.as_py())) for t in texts], pa.list_(pa.string()))

    return one.select("k", F.pmod(F.xxhash64("t"), F.lit(FOLDS)).cast("int").alias("fold"), all_words("t").alias("words"), *names)


def _word_counts(sample: DataFrame, names: list[str]) -> DataFrame:
    """(word, n, category sums): each task adds up its own rows first, so a common word is one row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = Counter(), [Counter() for _ in names]
        for batch in give_back(batches):
            for has, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total.update(has)
                for counter, v in zip(sums, values, strict=True):
                    if v:
                        counter.update(has)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64()),
                                          *(pa.array([c[w] for w in total], pa.int64()) for c in sums)], names=["word", "n", *names])

    part = sample.select("words", *names).mapInArrow(run, "word string, n long, " + ", ".join(f"{n} long" for n in names))
    return part.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])


def fit_chain(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              categories=CATEGORIES, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> dict:
    """{"words": {word: index}, "chain": [(category, weights)]}; weights: words, earlier categories, intercept."""
    names = [n for n, _ in categories]
    sample = stage(_sample(docs, labels, key, text, categories, max_rows), "labelled")
    total = sample.agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]).first()
    counts = stage(_word_counts(sample, names).where("n >= 5"), "words")
    words: dict[str, int] = {}
    for n in names:
        pos, all_ = float(total[n] or 0), float(total["n"])
        if not 0 < pos < all_:
            continue
        # squared deviation from the count expected of an uninformative word, over its variance
        expected = F.col("n") * (pos / all_)
        score = F.pow(F.col(n) - expected, 2) / (expected * (1 - pos / all_))
        for r in counts.orderBy(score.desc(), "word").limit(max_features).collect():
            words.setdefault(r["word"], len(words))
    drop_stage(counts)
    chosen = list(words)
    rows = sample.select("k", "fold", *names, F.array_intersect("words", F.array(*map(F.lit, chosen)).cast("array<string>")).alias("has")).toPandas()
    rows = rows.sort_values("k", kind="stable")  # the same sums whatever the partitioning
    drop_stage(sample)
    x = np.zeros((len(rows), len(words)))
    for i, has in enumerate(rows["has"]):
        x[i, [words[h] for h in has]] = 1
    fold = rows["fold"].to_numpy()
    chain = []
    for n in names:
        y = rows[n].to_numpy(dtype=float)
        chain.append((n, _fit(x, y)))
        held = np.empty(len(y))
        for f in range(FOLDS):
            held[fold == f] = _prob(x[fold == f], _fit(x[fold != f], y[fold != f]))
        x = np.hstack([x, held[:, None]])
    return {"words": words, "chain": chain}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Add ``toxicity``, a struct of each category's probability; the input's columns stay."""
    words, chain = model["words"], model["chain"]
    kind = "struct<" + ", ".join(f"{n}: double" for n, _ in chain) + ">"

    @F.arrow_udf(kind)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = words.keys()
        for s in give_back(texts):
            x = np.zeros((len(s), len(words)))
            none = np.zeros(len(s), dtype=bool)
            for i, t in enumerate(s):
                has = word_set(t.as_py())
                none[i] = not has
                x[i, [words[h] for h in vocabulary & has]] = 1
            out = []
            for _, w in chain:
                p = np.where(none, 0.0, _prob(x, w))
                out.append(pa.array(p))
                x = np.hstack([x, p[:, None]])
            yield pa.StructArray.from_arrays(out, names=[n for n, _ in chain])

    return docs.select("*", run(F.col(text)).alias(free(docs, "toxicity")))


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Documents that the last category does not reject; the input's columns."""
    model = fit_chain(docs, labels, key, text)
    scored = score(docs.select(F.struct("*").alias("__row"), F.col(text).alias("__t")), model, "__t")
    return scored.where(F.col(f"toxicity.{CATEGORIES[-1][0]}") < threshold).select("__row.*")


def op4_classifier_chain(spark, sf_dir):
    from .common import table

    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    p = F.col("toxicity")
    return score(docs, fit_chain(docs, labels)).select(
        "doc_id", p["low_quality"].alias("p_low_quality"), p["toxic"].alias("p_toxic"),
        (p["toxic"] >= 0.5).alias("toxic"), (p["toxic"] < 0.5).alias("kept"))
