"""The registered SQL against the queries on small tables in which each method changes rows."""

import random
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from walletweave.llm import queries

KEY, HEX, B64 = "AKIA" + "A1B2C3D4E5F6G7H8", "0123456789abcdef" * 2, "Zz9/" * 10


def both(spark, tmp_path, name, **tables):
    """(rows of the query, rows of its SQL), columns by name."""
    con = duckdb.connect()
    for table, rows in tables.items():
        pq.write_table(rows, tmp_path / f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    df = queries.QUERIES[name](spark, str(tmp_path))
    cols = sorted(df.columns)
    sql = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.SQL[name]})").fetchall()
    return [tuple(r) for r in df.select(*cols).collect()], sql, cols


def documents(texts, source=None):
    n = len(texts)
    return pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(["en"] * n),
                     "source": pa.array(source or ["s"] * n, pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())})


def test_secrets_with_links(spark, tmp_path):
    rng = random.Random(3)
    parts = [KEY, HEX, B64, "user_name=alice99", "client_id: abcdefgh", "https://db.example.com/x", "password = hunter22", "redis://h/0", "Zz9/" * 120]
    texts = [None, "", "plain"] + [
        " ".join(rng.choice(["x" * rng.randrange(1, 500), "two words", *parts]) for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    got, want, cols = both(spark, tmp_path, "op3_multipart_secrets", documents=documents(texts))
    assert Counter(got) == Counter(want)
    spans = [r[cols.index("spans")] for r in got]
    assert sum(any(k in s for k in ("weak:", "ident:", "endpoint:")) for s in spans) > 100


def test_hosts_that_reject_documents(spark, tmp_path):
    rng = random.Random(5)
    texts, source = [], []
    for host, bad in (("good", 0.05), ("bad", 0.9), ("half", 0.45), (None, 0.7), ("tiny", 1.0)):
        for _ in range(3 if host == "tiny" else 60):
            w = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(51, 90))]
            texts.append("a few words" if rng.random() < bad else " ".join(w))
            source.append(host)
    got, want, cols = both(spark, tmp_path, "op8_host_rules", documents=documents(texts, source))
    assert Counter(got) == Counter(want)
    flipped = [r for r in got if not r[cols.index("base_failed")] and not r[cols.index("kept")]]
    assert {source[r[cols.index("doc_id")]] for r in flipped} == {"bad", None}


def test_revisits_of_every_outcome(spark, tmp_path):
    rng = random.Random(7)
    url = lambda i: rng.choice([f"http://www.a{i % 9}.com/p?b=1&a=2", f"https://a{i % 9}.com/p?a=2&b=1", f"http://b{i}.com", None, "nonsense"])
    pages = pa.table({"page_id": pa.array(range(400), pa.int64()), "url": pa.array([url(i) for i in range(400)], pa.string()),
                      "html": pa.array([rng.choice(["<p>one</p>", "<p>two</p>", "", None]) for _ in range(400)], pa.string())})
    got, want, cols = both(spark, tmp_path, "op7_revisits", pages=pages)
    assert Counter(got) == Counter(want)
    assert set(Counter(r[cols.index("outcome")] for r in got)) == {"resolved", "unchecked", "mismatch", "missing"}


def test_near_duplicates(spark, tmp_path):
    rng = random.Random(2)
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.choice([2, 40, 90]))] for _ in range(30)]
    texts = [None, "", " "]
    for _ in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    got, want, _ = both(spark, tmp_path, "op1_minhash_forest", documents=documents(texts))
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("name", ["op1_minhash_forest", "op3_multipart_secrets", "op8_host_rules"])
def test_empty_documents(spark, tmp_path, name):
    got, want, _ = both(spark, tmp_path, name, documents=documents([]))
    assert got == want == []
