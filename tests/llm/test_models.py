import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from walletweave.llm import decontaminate as D
from walletweave.llm import language, tokens, toxicity


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n)]


# Toxicity ------------------------------------------------------------------------------------------


def toxic_corpus(n, seed=1):
    rng = random.Random(seed)
    bad, docs, labels = ["vile", "nasty", "foul"], [], []
    for i in range(n):
        w, toxic = words(rng, rng.randrange(20, 200)), rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad).upper() if i % 2 else rng.choice(bad) + ",")
        docs.append((i, " ".join(w), "keep"))
        labels.append((i, int(rng.random() < 0.9), int(toxic)))
    return docs, labels


DOCS, LABELS = "doc_id long, text string, toxicity string", "doc_id long, quality int, toxic int"


def test_chain_separates_held_out_documents(spark):
    docs, labels = toxic_corpus(900)
    df = spark.createDataFrame(docs + [(9001, None, "x"), (9002, "", "x"), (9003, "vile " + "calm " * 30_000, "x"), (0, docs[0][1], "again"), (None, "nasty", "x")], DOCS)
    model = toxicity.fit_chain(df, spark.createDataFrame(labels[:600] + [labels[0], (None, 1, 1), (5000, None, 1)], LABELS))
    assert [n for n, _ in model["chain"]] == ["low_quality", "toxic"]
    assert len(model["chain"][1][1]) == len(model["words"]) + 2  # words, the earlier category, the intercept
    rows = toxicity.score(df.drop("toxicity"), model).collect()
    p = {r.doc_id: r.toxicity.toxic for r in rows}
    assert all((p[i] >= 0.5) == bool(t) for i, _, t in labels[600:])
    assert p[9001] == p[9002] == 0 and p[9003] >= 0.5 and len(rows) == len(docs) + 5
    kept = toxicity.keep_clean(df, spark.createDataFrame(labels[:600], LABELS))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {i for i, _, t in labels[600:] if not t} | {9001, 9002}


def test_later_models_train_on_out_of_fold_predictions(spark, monkeypatch):
    docs, labels = toxic_corpus(100)
    seen = []
    fit = toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda x, y, **k: seen.append(x.shape) or fit(x, y, **k))
    toxicity.fit_chain(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    full, folds = [s for s in seen if s[0] == 100], [s for s in seen if s[0] < 100]
    assert len(full) == 2 and len(folds) == 2 * toxicity.FOLDS and full[1][1] == full[0][1] + 1


def test_without_labels_nothing_is_toxic(spark):
    df = spark.createDataFrame([(1, "anything", "x")], DOCS)
    assert toxicity.keep_clean(df, spark.createDataFrame([], LABELS)).count() == 1
    assert toxicity.keep_clean(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


# Language ------------------------------------------------------------------------------------------

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schn", "eich", "ung", "ver"], "cc": ["tion", "ing", "the", "ed"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_mixture(spark):
    rng = random.Random(3)
    train = [(i, speak(rng, lang, 80), lang) for i, lang in enumerate(list(SYLLABLES) * 20)] + [(900, None, "aa"), (901, "x", None)]
    model = language.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model[0] == ["aa", "bb", "cc"]
    mixed = speak(rng, "aa", 150) + " " + speak(rng, "bb", 50)
    rows = [(lang, speak(rng, lang, 30)) for lang in SYLLABLES for _ in range(20)] + [("und", None), ("und", ""), ("und", "123 !?"), ("aa", mixed), ("cc", speak(rng, "cc", 20_000))]
    got = language.predict(spark.createDataFrame(rows, "want string, text string"), model).collect()
    assert all(r.language.lang == r.want and 0 <= r.language.score <= 1 for r in got)
    both = next(r.language for r in got if r.text == mixed)
    assert both.langs == ["aa", "bb"] and sum(both.shares) == pytest.approx(1) and both.score == pytest.approx(0.68, abs=0.12)
    assert language.predict(spark.createDataFrame([], "text string"), model).count() == 0


def test_nothing_learned(spark):
    model = language.learn(spark.createDataFrame([], "text string, lang string"))
    assert language.predict(spark.createDataFrame([("abc",)], "text string"), model).first().language.lang == "und"


def test_held_out_rows_and_accuracy(spark):
    import zlib

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(docs.where(~language.held_out()))
    rows = language.predict(docs.withColumn("held", language.held_out()), model).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.held]
    assert np.mean([r.language.lang == r.lang for r in test]) > 0.95


# Tokens --------------------------------------------------------------------------------------------


def test_separator_scan_matches_the_encoder(spark, monkeypatch):
    rng = random.Random(5)
    texts = [None, "", "one", " ".join(words(rng, 5000))] + [" ".join(words(rng, rng.randrange(60))) for _ in range(200)] + ["<|endoftext|>"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(0, None, 1)], "doc_id long, text string, file int")
    with open(tokens.RANKS, "rb") as f:
        enc = tokens.encoder(f.read())
    want = Counter([(i, len(enc.encode_ordinary(t)) if t else 0) for i, t in enumerate(texts)] + [(0, 0)])
    monkeypatch.setattr(tokens, "BLOCK", 64)  # documents span many blocks
    blocks, manifest = tokens.pack(df.repartition(3))
    assert blocks.count() > 100
    got = manifest.join(tokens.scan(blocks), ["file", "ordinal"], "left")
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == want
    empty = tokens.pack(spark.createDataFrame([], "doc_id long, text string"))
    assert tokens.scan(empty[0]).count() == 0 and empty[1].count() == 0


@pytest.mark.parametrize("ids", [[], [9], [1, 2, 3], [9, 9], [1, 9, 2, 2, 9, 3], list(range(10, 40)) + [9] + list(range(10, 90)), [9] + [1] * 50])
def test_scan_of_flat_files(spark, monkeypatch, tmp_path, ids):
    monkeypatch.setattr(tokens, "BLOCK", 8)
    (tmp_path / "a.bin").write_bytes(np.array(ids, dtype=np.uint16).tobytes())
    want, last = [], 0
    for i, x in enumerate(ids):
        if x == 9:
            want.append(i - last)
            last = i + 1
    want += [len(ids) - last] if len(ids) > last else []
    got = sorted((r.ordinal, r.n_tokens) for r in tokens.scan(tokens.read_files(spark, str(tmp_path)), end=9).collect())
    assert got == list(enumerate(want))


def test_a_small_real_language_does_not_keep_the_spurious_ones():
    rng = random.Random(3)
    prose = ["".join(rng.choice(letters) for _ in range(20_000)) for letters in ("abcd ", "klmn ", "pqrs ", "wxyz ")]
    table = np.stack([np.bincount(language.trigrams(t), minlength=language.BUCKETS) for t in prose], axis=1) + 0.5
    who, shares = language.mixture(prose[0][:6000] + prose[1][:90], np.log(table / table.sum(axis=0)).astype(np.float32))
    assert who.tolist() == [0, 1] and 0.005 < shares[1] < 0.02


# Decontamination -----------------------------------------------------------------------------------


def distance(a, b):
    """Least word edits of ``a`` to any passage of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def hashed(text):
    return next(D.text_hashes(pa.array([text], pa.string())))


def test_words_are_those_of_the_pattern():
    """Equal words have equal hashes and others differ, whatever the texts beside them, over slices and nulls."""
    rng = random.Random(4)
    texts = [None, "", "É é ÉÉ", "a_b-c'd 12", "\tX  x\x0bY", "日本 language, İx", "x" * 300_000 + " y", "..."] + [
        "".join(rng.choice("abÉé _-1.,\n\x1c\x7f'ß") for _ in range(rng.randrange(80))) for _ in range(300)]
    found, seen = list(D.text_hashes(pa.array([None, *texts, "tail"], pa.string()).slice(1, len(texts)))), {}
    assert len(found) == len(texts)
    for t, h in zip(texts, found, strict=True):
        w = D.WORD.findall(t.lower()) if t else []
        assert len(w) == len(h)
        for word, value in zip(w, h.tolist(), strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen) > 100


def test_best_fit_is_exact():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        edits, lo, hi = D.best_fit(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
        assert edits == distance(a, b) and 0 <= lo <= hi <= len(b)


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(w))
        if kind == 0:
            w[at] = "".join(words(rng, 2))
        elif kind == 1:
            w.insert(at, "".join(words(rng, 2)))
        else:
            del w[at]
    return w


def test_recall_and_precision_against_brute_force(spark):
    rng = random.Random(9)
    common = words(rng, 12)
    items = [(i, [rng.choice(common) if rng.random() < 0.4 else "".join(words(rng, 1)) for _ in range(rng.randrange(15, 60))]) for i in range(30)]
    docs = []
    for d in range(240):
        w = [rng.choice(common) if rng.random() < 0.4 else "".join(words(rng, 1)) for _ in range(rng.randrange(0, 150))]
        if d % 2:
            _, own = items[d % 30]
            at = rng.randrange(len(w) + 1)
            w[at:at] = edited(rng, own, rng.randrange(0, len(own) // 4))
        docs.append((d, w))
    df = spark.createDataFrame([(d, ", ".join(w).title()) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(99, None), (98, " .,"), (0, " ".join(items[0][1]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.contamination(df, bench).collect()}
    hashes = {i: hashed(" ".join(w)).tolist() for i, w in items}
    want = {}
    for d, w in docs:
        h = hashed(" ".join(w)).tolist()
        for i, own in hashes.items():
            if (e := distance(own, h)) <= D.allowed(len(own)):
                want[d, i] = e
    assert set(got) <= set(want) and len(want) > 60
    assert len(got) >= D.TARGET_RECALL * len(want)
    assert np.mean([got[k].edits == want[k] for k in got]) > 0.95 and all(got[k].edits >= want[k] for k in got)


@pytest.mark.parametrize("insert", [False, True])
@pytest.mark.parametrize("n", [40, 59, 100, 150, 300])
def test_long_items_with_one_sided_edits_are_all_found(n, insert):
    rng = random.Random(n)
    items = [(i, [f"i{i}w{j}" for j in range(n)]) for i in range(12)]
    texts = []
    for _, own in items:
        w = list(own)
        for _ in range(D.allowed(n)):
            at = rng.randrange(len(w))
            w[at:at + (not insert)] = ["new"] * insert
        texts.append(hashed(" ".join(["before"] * 30 + w + ["after"] * 30)))
    index = D.Index([(i, " ".join(w)) for i, w in items])
    want = {(i, i) for i in range(12) if distance(index.items[i][1].tolist(), texts[i].tolist()) <= D.allowed(n)}
    assert len(want) == 12 and {(d, item) for d, item, *_ in index.matches(texts)} == want


def test_edge_cases_of_decontamination(spark):
    item = " ".join(words(random.Random(1), 40))
    rows = [(1, None), (2, ""), (3, item), (3, item), (4, "x " * 40_000 + item + " y" * 10), (5, item.upper().replace(" ", " -- ")), (None, item), (6, item[:60]), (7, "clean text")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert Counter(r.doc_id for r in D.contamination(df, bench).collect()) == Counter([3, 3, 4, 5, None])
    clean = D.keep_uncontaminated(df, bench)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {1, 2, 6, 7}
    assert D.keep_uncontaminated(df, bench.limit(0)).count() == len(rows)
    assert D.contamination(df.limit(0), bench).count() == 0


def test_rows_are_judged_one_by_one_and_in_passes(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    items = [" ".join(words(random.Random(i), 30)) for i in range(5)]
    big = 2**60
    rows = [(None, items[0], "a"), (None, "clean one", "b"), (big + 1, items[4], "c"), (big + 1, "clean two", "d"), (big + 2, "x " + items[2], "e"), (None, None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, all string").coalesce(1)
    bench = spark.createDataFrame([(big + i, t) for i, t in enumerate(items)], "item_id long, text string")
    assert Counter((r.doc_id, r.item_id) for r in D.contamination(df, bench).collect()) == Counter([(None, big), (big + 1, big + 4), (big + 2, big + 2)])
    kept = D.keep_uncontaminated(df, bench)
    assert kept.columns == df.columns and sorted(r["all"] for r in kept.collect()) == ["b", "d", "f"]
