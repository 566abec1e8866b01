import random
import re

import numpy as np
import pyarrow as pa
import pytest

from walletweave.llm import neardup
from walletweave.llm.shingles import shingle_sets


def brute(rows, k, percent):
    """{row number: (n_shingles, component)} by comparing all pairs of sets."""
    sets = [set(s.tolist()) for s in shingle_sets(pa.array([t for _, t in rows], pa.string()), k)]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(rng.choice([30, 80, 200]))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 15])):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else "\t".join(w)))
    return rows


@pytest.mark.parametrize("k,threshold", [(3, 0.85), (5, 0.8)])
def test_components_match_brute_force(spark, k, threshold):
    rows = corpus(k, 400)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=k, threshold=threshold).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, k, round(100 * threshold)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_regions_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, threshold=0.85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 3, 85))


def template(seed, n, shared, own):
    """Documents of one template, every third a near-copy of the one before it."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(shared)]
    rows, last = [], None
    for i in range(n):
        if i % 3 == 1:
            w = list(last)
            for at in range(shared + 2, shared + own, own // 5):  # a similarity just above 0.85
                w[at] = f"y{rng.randrange(10**6)}"
        else:
            w = base + [f"x{rng.randrange(10**6)}" for _ in range(own)]
        rows.append((i, " ".join(w)))
        last = w
    return rows


def test_regions_beyond_the_split_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "SPLIT", 2)
    rows = template(1, 150, 170, 50)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, threshold=0.85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 3, 85))


@pytest.mark.parametrize("n_blocks", range(1, 14))
def test_every_pair_of_blocks_has_one_unit(spark, n_blocks):
    members = spark.createDataFrame([(7, n_blocks, b) for b in range(n_blocks)], "root long, n_blocks int, block int")
    units = {}
    for first in range(0, n_blocks // 2 + 1, 2):
        for r in neardup._deal(members, first, first + 2).collect():
            units.setdefault(r.unit, set()).add((r.side, r.block))
    pairs = sorted(tuple(sorted(b for _, b in sides)) for sides in units.values())
    assert all(sorted(s for s, _ in sides) == [0, 1][:len(sides)] for sides in units.values())
    assert pairs == sorted([(b,) for b in range(n_blocks)] + [(a, b) for b in range(n_blocks) for a in range(b)])


def test_oversized_units_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    near = [" ".join([f"a{i}" for i in range(60)] + [f"z{j}"]) for j in range(2)]
    fill = [" ".join(f"b{k}x{i}" for i in range(20)) for k in range(40)]
    rows = [(1, 0, t) for t in [near[0], *fill, near[1]]]
    texts = spark.createDataFrame(rows, "unit long, side int, t string").selectExpr("*", "side AS sub").coalesce(1)
    assert neardup.verified_links(texts, 3, 85).count() == 1


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", "a"), (4, "One two", "a"), (5, "one  TWO", "a"), (6, "one two three", "a"), (7, long, "a"), (8, long, "b"),
            (8, long, "b"), (None, "solo words here now", "c"), (9, "É x y", "a"), (10, "é x y", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = neardup.near_duplicates(df, shingle=3, threshold=0.85).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str)
    assert len(got) == len(rows)
    as_dict = {r.doc_id: r for r in got}
    assert [as_dict[i].n_shingles for i in (1, 2, 3, 4, 5, 6)] == [0, 0, 0, 1, 1, 1]
    assert [as_dict[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] == [1, 2, 3, 4, 4, 6, 7, 7, 9, 10]
    assert as_dict[None].kept and as_dict[None].component_id is None, found
    kept = neardup.keep_representatives(df, shingle=3, threshold=0.85)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 7, None, 9, 10}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(df).count() == 0
    assert neardup.near_duplicates(spark.createDataFrame([(1, None)], df.schema)).count() == 1


def test_shingles_are_those_of_the_words():
    """Set sizes and equality follow the word rule, over slices, nulls and offsets."""
    rng = random.Random(2)
    texts = [None, "", " \t", "a", "A  b", "a b", "a b c", "É x y z", "x" * 300_000 + " q r s"] + ["".join(rng.choice("abAB \t\n\x0b\x1cé\u00a0") for _ in range(rng.randrange(40))) for _ in range(400)]
    found = list(shingle_sets(pa.array(["skip", *texts], pa.string()).slice(1), 3))
    assert len(found) == len(texts)
    by_set = {}
    for t, s in zip(texts, found, strict=True):
        w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        want = frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()
        assert by_set.setdefault(want, s.tobytes()) == s.tobytes()
    assert len(set(by_set.values())) == len(by_set)


def test_links_of_long_and_many_sets_match_brute_force():
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**60, 3000).astype(np.uint64)
    sets = []
    for i in range(120):
        keep = rng.random(3000) > [0.0, 0.05, 0.08, 0.2][i % 4]
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(1, 2**60, [0, 40, 300, 700][i // 4 % 4]).astype(np.uint64)])))
    sets += [np.array([7], dtype=np.uint64), np.array([7, 9], dtype=np.uint64)]
    for split in (0, 50):
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if not split or j < split <= i]
        want, got = neardup.Forest(), neardup.Forest()
        for i, j in pairs:
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                want.link(i, j)
        for i, j in neardup._links(sets, list(range(len(sets))), 85, split):
            assert got.link(i, j)
        assert [want.root(i) for i in range(len(sets))] == [got.root(i) for i in range(len(sets))]


def test_rows_with_null_and_repeated_ids(spark):
    big = 2**60
    same = "one two three four five six seven eight"
    rows = [(None, same, "a"), (None, same, "b"), (big + 1, same + " nine", "c"), (big + 1, "other words in this text are kept", "d"),
            (None, "a text of its own stays here", "e"), (big + 2, same, "f"), (big + 2, same, "g"), (None, None, "h"), (None, "", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").coalesce(1)
    got = neardup.near_duplicates(df, shingle=3, threshold=0.85).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(None, big + 1), (None, big + 1), (big + 1, big + 1), (big + 1, big + 1), (None, None), (big + 2, big + 1), (big + 2, big + 1), (None, None), (None, None)], key=str)
    kept = neardup.keep_representatives(df, shingle=3, threshold=0.85)
    assert kept.columns == df.columns and sorted(r["row"] for r in kept.collect()) == ["c", "d", "e", "h", "i"]
    twice = neardup.keep_representatives(spark.createDataFrame(rows[:2] + rows[5:7] * 3 + [(None, "solo text here", "x")] * 4, df.schema).repartition(3))
    assert sorted(r.text for r in twice.collect()) == [same, "solo text here"]


def test_hot_keys_are_looked_up_right(spark, monkeypatch):
    from walletweave.llm import common

    monkeypatch.setattr(common, "HOT", 4)
    left = spark.createDataFrame([(i, None if i % 10 == 0 else 7 if i % 2 else i % 50) for i in range(300)], "i long, g long")
    right = left.where("g is not null").groupBy("g").count().where("g <> 4").selectExpr("g", "count AS m", "g * 2 AS v", "string(g) AS w")
    got = common.join_hot(left, right, "g", "m", spread="i")
    assert got.columns == ["i", "g", "v", "w"] and got.count() == 300
    assert all(r.v == (None if r.g in (None, 4) else 2 * r.g) and (r.v is None) == (r.w is None) for r in got.collect())
