"""Operators that SQL cannot express against versions written as plain loops."""

import math
import random
from collections import Counter

import pytest
import xxhash

from walletweave.llm import language, toxicity

# Classifier chain ----------------------------------------------------------------------------------


def solve(a, b):
    """Gaussian elimination."""
    n = len(b)
    m = [[*row, y] for row, y in zip(a, b, strict=True)]
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(i + 1, n):
            f = m[r][i] / m[i][i]
            for c in range(i, n + 1):
                m[r][c] -= f * m[i][c]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (m[i][n] - sum(m[i][c] * out[c] for c in range(i + 1, n))) / m[i][i]
    return out


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(rows, y, ridge=0.01):
    """Ridge logistic regression, the last weight the intercept, by Newton steps in loops."""
    d = len(rows[0]) + 1
    x = [[*r, 1.0] for r in rows]
    w, keep = [0.0] * d, [ridge] * (d - 1) + [1e-6]
    for _ in range(12):
        p = [sigmoid(sum(a * b for a, b in zip(r, w, strict=True))) for r in x]
        grad = [sum(r[j] * (q - t) for r, q, t in zip(x, p, y, strict=True)) + keep[j] * w[j] for j in range(d)]
        hess = [[sum(r[i] * r[j] * (q * (1 - q) + 1e-9) for r, q in zip(x, p, strict=True)) + (keep[i] if i == j else 0) for j in range(d)] for i in range(d)]
        step = solve(hess, grad)
        w = [a - b for a, b in zip(w, step, strict=True)]
        if max(map(abs, step)) < 1e-4:
            break
    return w


def predict(rows, w):
    return [sigmoid(sum(a * b for a, b in zip([*r, 1.0], w, strict=True))) for r in rows]


def chain(train, texts, max_features):
    """Probabilities (low quality, toxic) of ``texts``; train: (text, low, toxic)."""
    sets = [toxicity.word_set(t) for t, *_ in train]
    n, chosen = len(train), []
    counts = Counter(w for s in sets for w in s)
    for c in (1, 2):
        pos = sum(t[c] for t in train)
        hits = Counter(w for s, t in zip(sets, train, strict=True) if t[c] for w in s)
        score = {w: (hits[w] - k * (pos / n)) ** 2 / (k * (pos / n) * (1 - pos / n)) for w, k in counts.items() if k >= 5}
        for w in sorted(score, key=lambda w: (-score[w], w))[:max_features]:
            if w not in chosen:
                chosen.append(w)
    x = [[float(w in s) for w in chosen] for s in sets]
    signed = [int.from_bytes(xxhash.xxh64(t.encode(), seed=42).digest(), "big", signed=True) for t, *_ in train]
    fold = [h % toxicity.FOLDS for h in signed]
    new = [[float(w in toxicity.word_set(t)) for w in chosen] for t in texts]
    out = []
    for c in (1, 2):
        y = [t[c] for t in train]
        p = predict(new, logistic(x, y))
        held = [0.0] * n
        for f in range(toxicity.FOLDS):
            w = logistic([r for r, k in zip(x, fold, strict=True) if k != f], [v for v, k in zip(y, fold, strict=True) if k != f])
            for i in range(n):
                if fold[i] == f:
                    held[i] = predict([x[i]], w)[0]
        x = [[*r, h] for r, h in zip(x, held, strict=True)]
        out.append(p)
        new = [[*r, q] for r, q in zip(new, p, strict=True)]
    return list(zip(*out, strict=True))


def test_the_chain_is_that_of_plain_loops(spark):
    rng = random.Random(6)
    common, bad, poor = [f"word{i}" for i in range(12)], ["vile", "foul"], ["lorem", "ipsum"]
    train = []
    for _ in range(90):
        low, toxic = rng.random() < 0.3, rng.random() < 0.3
        w = rng.sample(common, 6) + (rng.sample(poor, 1) if low and rng.random() < 0.9 else []) + (rng.sample(bad, 1) if toxic and rng.random() < 0.9 else [])
        train.append((" ".join(w), int(low), int(toxic)))
    texts = [t for t, *_ in train] + ["vile", "word1 foul lorem", "nothing known"]
    want = chain(train, texts, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1 - low, toxic) for i, (_, low, toxic) in enumerate(train)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, toxicity.fit_chain(docs, labels, max_features=4)).collect()}
    for i, (low, toxic) in enumerate(want):
        assert got[i].low_quality == pytest.approx(low, abs=2e-3) and got[i].toxic == pytest.approx(toxic, abs=2e-3)


def test_training_rows_are_bounded(spark):
    """An id that holds most rows is one row of the sample; equal texts share a fold."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(i, f"same {i % 3}") for i in range(2, 300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 300)], "doc_id long, quality int, toxic int")
    sample = toxicity._sample(docs, labels, "doc_id", "text", toxicity.CATEGORIES, 100)
    rows = sample.collect()
    assert len(rows) <= 200 and len({r.k for r in rows}) == len(rows)
    folds = {}
    for r in rows:
        folds.setdefault(tuple(r.words), set()).add(r.fold)
    assert all(len(f) == 1 for f in folds.values())


# Language mixture ----------------------------------------------------------------------------------


def buckets(text):
    b = b" " + text.lower().encode() + b" "
    return [((((b[i] << 16) | (b[i + 1] << 8) | b[i + 2]) * 2654435761) & 0xFFFFFFFF) >> 16 for i in range(len(b) - 2)]


def em(like, n, pi):
    total = sum(n)
    for _ in range(language.ROUNDS):
        mixed = [sum(a * b for a, b in zip(row, pi, strict=True)) for row in like]
        new = [p * sum(row[j] * k / m for row, k, m in zip(like, n, mixed, strict=True)) / total for j, p in enumerate(pi)]
        done = max(abs(a - b) for a, b in zip(new, pi, strict=True)) < 1e-3
        pi = new
        if done:
            break
    return pi, sum(k * math.log(sum(a * b for a, b in zip(row, pi, strict=True))) for row, k in zip(like, n, strict=True))


def mixture(text, models):
    """[(language, share)] chosen by the criterion, largest share first; models: log likelihood by bucket."""
    counts = Counter(buckets(text))
    grams, n, live = list(counts), list(counts.values()), list(range(len(models)))
    top = [max(m[g] for m in models) for g in grams]
    like = lambda who: [[math.exp(models[j][g] - t) for j in who] for g, t in zip(grams, top, strict=True)]
    pi, fit = em(like(live), n, [1 / len(live)] * len(live))
    penalty = 0.5 * math.log(max(2.0, sum(n)))
    while len(live) > 1:
        least = min(range(len(live)), key=lambda j: pi[j])
        keep = [j for j in range(len(live)) if pi[j] > 0.02 and j != least] or [max(range(len(live)), key=lambda j: pi[j])]
        tries = [keep] + [[j for j in range(len(live)) if j != i] for i in sorted(range(len(live)), key=lambda j: pi[j])]
        for keep in tries:
            start = [pi[j] for j in keep]
            now, less = em(like([live[j] for j in keep]), n, [p / sum(start) for p in start])
            if less + penalty * (len(live) - len(keep)) >= fit:
                break
        else:
            break
        live, pi, fit = [live[j] for j in keep], now, less
    return sorted(zip(live, pi, strict=True), key=lambda x: (-x[1], x[0]))


def test_mixtures_are_those_of_plain_loops(spark):
    rng = random.Random(11)
    tongues = {"aa": "kalomitu ", "bb": "schneiug ", "cc": "tionghed "}
    speak = lambda lang, n: "".join(rng.choice(tongues[lang]) for _ in range(n))
    train = [(lang, speak(lang, 400)) for lang in tongues for _ in range(6)]
    texts = [speak(rng.choice(list(tongues)), rng.randrange(1, 200)) + rng.choice(["", " " + speak(rng.choice(list(tongues)), rng.randrange(1, 120))]) for _ in range(60)]
    texts = [t for t in texts if t.strip()]
    models = []
    for lang in sorted(tongues):
        counts = Counter(g for a, t in train if a == lang for g in buckets(t))
        total = sum(counts.values()) + 0.5 * language.BUCKETS
        models.append({g: math.log((counts[g] + 0.5) / total) for t in texts for g in buckets(t)})
    model = language.learn(spark.createDataFrame(train, "lang string, text string"))
    got = {r.text: r.language for r in language.predict(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()}
    both = 0
    for t in texts:
        want = mixture(t, models)
        assert got[t].langs == [sorted(tongues)[j] for j, _ in want], t
        assert got[t].shares == pytest.approx([p for _, p in want], abs=1e-3)
        assert (got[t].lang, got[t].score) == (got[t].langs[0], pytest.approx(min(1.0, got[t].shares[0])))
        both += len(want) > 1
    assert 5 < both < len(texts)


def test_letters_are_of_the_letter_categories(spark):
    model = language.learn(spark.createDataFrame([("aa", "some text")], "lang string, text string"))
    rows = [("½", "und"), ("²", "und"), ("Ⅳ", "und"), ("1_2", "und"), ("x²", "aa"), ("日", "aa"), ("ª", "aa")]
    got = language.predict(spark.createDataFrame(rows, "text string, want string"), model).collect()
    assert all(r.language.lang == r.want for r in got)
