import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from walletweave.llm import pieces as P

TEXTS = [None, "", " ", "the cat", "a  b\n\n c.", "▁x", "日本 ñandú ß\U0001f600", "x" * 3000, "it's 3.5%!", "\tTab", "end ", "", "###secret###"]


@pytest.fixture(scope="module")
def vocabulary():
    return P.read_vocabulary()


def enumerate_all(vocabulary, text):
    """Every segmentation with its log probability, by recursion over the whole normalised text."""
    weight = {t: -math.log(i + P.RANK_SHIFT) for t, i in vocabulary["pieces"]}
    ids = dict(vocabulary["pieces"])
    norm = P.BLANK + text.replace(" ", P.BLANK)

    def go(i):
        if i == len(norm):
            yield (), 0.0
            return
        for j in range(i + 1, len(norm) + 1):
            piece = norm[i:j]
            if piece in weight:
                for rest, w in go(j):
                    yield (ids[piece], *rest), weight[piece] + w

    found = dict(go(0))
    total = math.log(sum(math.exp(w) for w in found.values()))
    return {k: w - total for k, w in found.items()}


@pytest.mark.parametrize("text", ["cat", "the cat", "a b", "no."])
def test_samples_are_exact(vocabulary, text):
    want = enumerate_all(vocabulary, text)
    lat, n, k = P.Lattice(vocabulary), 6000, 3
    first, second = Counter(), Counter()
    for found, threshold in P.encode_slice(lat, list(range(n)), [text] * n, k):
        keys = [tuple(x.tolist()) for x, _, _ in found]
        assert len(keys) == len(set(keys)) == min(k, len(want))
        assert all(abs(logp - want[key]) < 1e-4 for key, (_, logp, _) in zip(keys, found, strict=True))
        noisy = [g for _, _, g in found]
        assert noisy == sorted(noisy, reverse=True) and threshold <= noisy[-1]
        first[keys[0]] += 1
        second[keys[:2] and tuple(keys[:2])] += 1
    for key, logp in want.items():
        p = math.exp(logp)
        assert abs(first[key] - n * p) < 5 * math.sqrt(n * p) + 3
    for a, b in itertools.permutations(want, 2):
        p = math.exp(want[a] + want[b]) / (1 - math.exp(want[a])) if want[a] < -1e-9 else 0
        assert abs(second[a, b] - n * p) < 5 * math.sqrt(n * p) + 4


def test_operator_and_round_trip(spark):
    df = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(TEXTS)] + [(0, None, "again"), (None, "no key", "x")], "doc_id long, text string, ids string")
    out = P.sample_encode(df, k=2)
    rows = out.collect()
    assert all(r.round_trip for r in rows)
    assert {r.doc_id for r in rows} == set(range(len(TEXTS))) | {None}
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (str(r.doc_id), r["sample"])), key=lambda r: r.doc_id):
        group = list(group)
        distinct = {tuple(r.ids) for r in group}
        assert len(distinct) in (1, 2) and all(r.inclusion <= 0 for r in group)
    back = {(r.doc_id, r.decoded) for r in P.decode(out).collect()}
    assert {(i, t or "") for i, t in enumerate(TEXTS)} | {(None, "no key")} == back


def test_results_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i, f"the quick brown fox {i} jumps") for i in range(40)], "doc_id long, text string")
    one = sorted(map(tuple, P.sample_encode(df.coalesce(1), k=3).select("doc_id", "sample", "log_prob", "inclusion").collect()))
    many = sorted(map(tuple, P.sample_encode(df.repartition(7), k=3).select("doc_id", "sample", "log_prob", "inclusion").collect()))
    assert one == many and len(one) == 120


def test_empty_table(spark):
    assert P.sample_encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_inclusion_scores_are_probabilities(vocabulary):
    lat = P.Lattice(vocabulary)
    sums = []
    for found, threshold in P.encode_slice(lat, list(range(4000)), ["cat"] * 4000, 2):
        weights = [math.exp(logp) / -math.expm1(-math.exp(logp - threshold)) for _, logp, _ in found] if threshold > -math.inf else [math.exp(x[1]) for x in found]
        sums.append(sum(weights))  # inverse inclusion weighting estimates the total mass, 1
    assert abs(np.mean(sums) - 1) < 0.05


def test_chunks_cover_the_text_and_lose_no_piece(vocabulary):
    """Chunks end where the rule says, by a plain pattern, and no piece reaches over an end."""
    lat = P.Lattice(vocabulary)
    marks = re.escape("".join(chr(i) for i in range(P.ASIDE) if lat.cut[i]))
    rule = re.compile(f"\n|{P.BLANK}*{P.LATIN}+(?=[{marks}])|{P.BLANK}+[^{P.BLANK}\n]*|[^{P.BLANK}\n]+")
    rng = random.Random(3)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("ab \n.,'-1é日▁#") for _ in range(rng.randrange(60))) for _ in range(400)]
    cp, starts, before = lat.chunks(texts)
    whole = "".join(map(chr, cp.tolist()))
    parts = [whole[a:b] for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(whole)], strict=True)]
    for i, t in enumerate(texts):
        norm = P.BLANK + t.replace(P.BLANK, P.MARK).replace(" ", P.BLANK) if t else ""
        assert parts[before[i]:before[i + 1]] == rule.findall(norm), repr(t)
    ends = re.compile(f"(?<={P.LATIN})[{marks}]|(?<=[^{P.BLANK}]){P.BLANK}|\n")
    assert not [t for t, _ in vocabulary["pieces"] if ends.search(t)]


def test_slices_without_a_chunk(spark, vocabulary):
    lat = P.Lattice(vocabulary)
    assert [x for x, _ in P.encode_slice(lat, [1, 2], ["", ""], 2)] and list(P.encode_slice(lat, [], [], 2)) == []
    df = spark.createDataFrame([(1, None), (2, ""), (2**60 + 1, "")], "doc_id long, text string").coalesce(1)
    rows = P.sample_encode(df).collect()
    assert sorted((r.doc_id, r.n_pieces, r.log_prob, r.round_trip) for r in rows) == [(1, 0, 0, True), (2, 0, 0, True), (2**60 + 1, 0, 0, True)]


def test_known_chunks_are_forgotten_when_full_without_a_trace(vocabulary, monkeypatch):
    monkeypatch.setattr(P, "PLACES", 64)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(12)) for _ in range(30)] + ["z" * 500]
    small, out = P.Lattice(vocabulary), []
    for i, t in enumerate(texts):
        out += [(x.tolist(), p, g) for x, p, g in next(P.encode_slice(small, [i], [t], 3))[0]]
    monkeypatch.undo()
    whole = [(x.tolist(), p, g) for found, _ in P.encode_slice(P.Lattice(vocabulary), list(range(len(texts))), texts, 3) for x, p, g in found]
    assert out == whole


def test_round_trip_is_checked(vocabulary):
    lat, decode = P.Lattice(vocabulary), P.Decoder(vocabulary)
    ids = [found[0][0] for found, _ in P.encode_slice(lat, [0, 1, 2], ["one two", "", "é▁"], 1)]
    assert decode.gives(ids, ["one two", "", "é▁"]) == [True] * 3
    assert decode.gives(ids, ["one tw", "", "é▁"]) == [False, True, True]
    assert decode.gives(ids, ["one twoé", "", "▁"]) == [False, True, False] and decode.gives([], []) == []
