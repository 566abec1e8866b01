import hashlib
import random

import pytest
from pyspark.sql import functions as F

from walletweave.functions import ids, scores, u256
from walletweave.sources import seeds

from .helpers import address, hex64


def stable(*parts):
    raw = b"".join(len(str(p).encode()).to_bytes(8, "big") + str(p).encode() for p in parts)
    return hashlib.sha256(raw).hexdigest()


def test_stable_ids(spark):
    df = spark.createDataFrame([(7, "ä|b", ["x", "yy", ""])], "n long, s string, a array<string>")
    row = df.select(ids.stable_id(F.col("n"), F.col("s"), "native"), ids.stable_id_of(F.col("a"), F.col("n"), "cluster")).first()
    assert row[0] == stable(7, "ä|b", "native")
    assert row[1] == stable(7, "cluster", "x", "yy", "")


def test_addresses_and_pairs(spark):
    rows = [(address(1).upper().replace("0X", "0x"),), (address(0),), ("0x12",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string").select(ids.valid_address(F.col("a"))).collect()]
    assert got == [True, False, False, False]
    low, high = ids.canonical_pair(F.lit("0xB"), F.lit("0xA"))
    assert tuple(spark.range(1).select(low, high).first()) == ("0xa", "0xb")
    with pytest.raises(Exception, match="distinct"):
        spark.range(1).select(ids.canonical_pair(F.lit("0xA"), F.lit("0xa"))[0]).first()


def test_u256(spark):
    rng = random.Random(1)
    values = [0, 1, 2**255, 2**256 - 1, 10**18] + [rng.getrandbits(rng.randrange(1, 257)) for _ in range(100)]
    df = spark.createDataFrame([(hex64(v), hex(v)) for v in values], "h string, q string")
    got = df.select(u256.to_decimal(F.col("h")), u256.from_quantity(F.col("q")), "h").collect()
    assert [r[0] for r in got] == [str(v) for v in values]
    assert all(r[1] == r[2] for r in got)
    small = [v >> 8 for v in values]
    total = spark.createDataFrame([(hex64(v),) for v in small], "h string").agg(u256.sum_(F.col("h"))).first()[0]
    assert int(total, 16) == sum(small)
    with pytest.raises(Exception, match="256 bits"):
        spark.createDataFrame([(hex64(2**256 - 1),), (hex64(1),)], "h string").agg(u256.sum_(F.col("h"))).collect()
    assert spark.createDataFrame([], "h string").agg(u256.sum_(F.col("h"))).first()[0] == "0" * 64


@pytest.mark.parametrize("counts,expected", [((4, 0, 0), (1, 1, 1)), ((0, 0, 3), (None, 0, None)), ((0, 2, 0), (0, None, None)), ((2, 1, 1), (2 / 3, 2 / 3, 2 / 3)),
                                             ((0, 1, 1), (0, 0, None))])
def test_prf(spark, counts, expected):
    df = spark.createDataFrame([counts], "tp long, fp long, fn long")
    df = df.select(scores.precision(F.col("tp"), F.col("fp")).alias("p"), scores.recall(F.col("tp"), F.col("fn")).alias("r"))
    row = df.select("p", "r", scores.f1(F.col("p"), F.col("r"))).first()
    assert tuple(row) == pytest.approx(expected)


def test_delta_truncates_the_difference(spark):
    row = spark.sql("SELECT timestamp'2024-01-01 00:00:00.9' AS a, timestamp'2024-01-01 00:00:02.8' AS b").select(
        scores.delta_seconds(F.col("a"), F.col("b")), scores.delta_seconds(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (1, 1)


def test_enum_order_and_float(spark):
    assert [scores.SEVERITY_RANK[x] for x in ("critical", "warning", "info")] == [3, 2, 1]
    assert spark.range(1).select(scores.stored_float(F.lit(0.8))).first()[0] == pytest.approx(0.800000011920929, abs=1e-15)


HEAD = ",".join(seeds.HEADER)
LINE = f"1,{address(1)},Acme  Swap,dex,router,docs,page,0.5,"


def test_seed_files(spark, tmp_path):
    rows = seeds.parse("﻿" + "\n".join([HEAD, LINE, LINE]))
    assert len(rows) == 1 and rows[0]["entity_name"] == "Acme Swap"
    assert seeds.digest(rows).startswith("sha256:")
    for bad in (LINE.replace("dex", "shop"), LINE.replace("router", "x"), LINE.replace("0.5", "1.01"), LINE.replace(address(1), "0x1"), LINE.replace("1,0x", "0,0x")):
        with pytest.raises(ValueError):
            seeds.parse("\n".join([HEAD, bad]))
    with pytest.raises(ValueError, match="conflicting"):
        seeds.parse("\n".join([HEAD, LINE, LINE.replace("0.5", "0.6")]))
    with pytest.raises(ValueError, match="header"):
        seeds.parse("a,b\n")
    (tmp_path / "s.csv").write_text("\n".join([HEAD, LINE]))
    assert seeds.to_frame(spark, seeds.read(spark, str(tmp_path / "s.csv"))).count() == 1


def test_seed_rules_and_digest():
    rows = seeds.parse("\n".join([HEAD, LINE.replace("docs", "Docs")]))
    assert rows[0]["source_type"] == "docs" and seeds.digest(rows) == seeds.digest(seeds.parse("\n".join([HEAD, LINE])))
    with pytest.raises(ValueError, match="zero address"):
        seeds.parse("\n".join([HEAD, LINE.replace(rows[0]["address"], "0x" + "0" * 40)]))
    r = rows[0]
    text = ('[{"address":"%s","chain_id":%d,"confidence":"%s","contract_role":"%s","entity_category":"%s","entity_name":"%s","notes":"%s","source_reference":"%s","source_type":"docs"}]'
            % (r["address"], r["chain_id"], format(r["confidence"], ".17g"), r["contract_role"] or "", r["entity_category"], r["entity_name"], r["notes"] or "", r["source_reference"]))
    assert seeds.digest(rows) == "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_names_are_case_folded(spark):
    """As str.casefold folds them, for every letter of the Latin, Greek and Cyrillic scripts."""
    chars = [chr(i) for i in range(0x20, 0x530) if chr(i).isalpha()] + list("ẞﬁΩ")
    names = [f"A{c}b" for c in chars] + ["  Straße  ΣΟΦΟΣ  x ", "σοφος"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(ids.normalize_name(F.col("n"))).collect()]
    want = [" ".join(n.split()).casefold() for n in names]
    odd = [(n, g, w) for n, g, w in zip(names, got, want, strict=True) if g != w]
    assert not odd, odd
