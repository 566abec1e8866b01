"""Cases that every operator must meet: odd ids, empty partitions and tables, long texts, clashing names."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from walletweave.llm import decontaminate, language, neardup, pieces, quality, secrets, sharding, tokens, toxicity, warc
from walletweave.llm.common import stage

BIG = 2**60
ITEM = " ".join(f"item{i}" for i in range(30))
SECRET = "password = hunter2222"
LONG = " ".join(f"w{i}" for i in range(40_000))
#: Every name that an operator adds or once used inside, as a column of the input.
NAMES = ("added", "secrets", "rules", "host_rules", "kept", "language", "toxicity", "decoded", "all", "row", "t", "r", "k", "h", "node", "file", "salt", "rows",
         "__t", "__row", "__key", "__kept", "__bad", "__host", "__spread", "__at", "__hot", "component_id", "at", "found", "cut", "worded", "ids", "sample")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), *(f"{n} of {i}" for n in NAMES))


ROWS = [row(None, "a text without an id, one"), row(None, f"another without an id {SECRET}"), row(BIG + 1, f"{ITEM} and more"), row(BIG + 1, "the same id, another text"),
        row(BIG + 2, "an id beyond the doubles"), row(BIG + 2, "an id beyond the doubles"), row(3, None), row(4, ""), row(5, " \n\t "), row(6, LONG, None, None),
        row(7, "½ ² 123", "de"), row(8, "vile words", "en", None), row(8, "vile words", None, "t")]


@pytest.fixture(scope="module")
def docs(spark):
    """One partition with the rows, one with empty texts only, one without a row."""
    rows = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    blank = spark.createDataFrame([row(100, None), row(101, "")], SCHEMA).coalesce(1)
    return rows.unionAll(blank).unionAll(spark.createDataFrame([], SCHEMA).coalesce(1))


TEXTS = Counter((r[0], r[1]) for r in [*ROWS, row(100, None), row(101, "")])


def carried(out):
    """Every input column has its own value still, in every row."""
    names = [c for c in SCHEMA.replace("`", "").split(", ")]
    rows = out.select(*[F.col(f"`{c.split()[0]}`") for c in names]).collect()
    for r in rows:
        assert all(r[n] == f"{n} of {r.doc_id}" for n in NAMES)
    return Counter((r.doc_id, r.text) for r in rows)


def test_near_duplicates(docs):
    got = neardup.near_duplicates(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in TEXTS.elements())
    kept = neardup.keep_representatives(docs)
    assert kept.columns == docs.columns and carried(kept) == Counter(set(TEXTS))


def test_sampled_encoding(docs):
    got = pieces.sample_encode(docs.select("doc_id", "text", "ids", "sample"))
    assert all(r.round_trip for r in got.select("round_trip").collect())
    first = Counter(r.doc_id for r in got.where("sample = 0").collect())
    assert first == Counter(i for i, _ in TEXTS.elements())
    assert set(r.decoded for r in pieces.decode(got).where("sample = 0").collect()) == {t or "" for _, t in TEXTS}


def test_secrets(docs):
    out = secrets.scan(docs)
    assert out.columns == [*docs.columns, "secrets_"] and carried(out) == TEXTS
    assert {(r.doc_id, r.text) for r in out.where("size(secrets_) > 0").collect()} == {(None, f"another without an id {SECRET}")}
    clean = secrets.redact(docs)
    want = Counter((i, t and t.replace(SECRET, "[REDACTED]")) for i, t in TEXTS.elements())
    assert clean.columns == docs.columns and carried(clean) == want


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(BIG + 2, 1, 0), (8, 1, 1), (8, 1, 1), (None, 1, 1), (3, 1, 0), (77, 0, None)], LABELS)
    out = toxicity.score(docs, toxicity.fit_chain(docs, labels))
    assert out.columns == [*docs.columns, "toxicity_"] and carried(out) == TEXTS
    assert not out.where("text IS NULL AND toxicity_.toxic > 0").count()
    assert toxicity.keep_clean(docs, labels).columns == docs.columns


def test_language(docs):
    out = language.predict(docs, language.learn(docs))
    assert out.columns == [*docs.columns, "language_"] and carried(out) == TEXTS
    assert {r.text for r in out.where("language_.lang = 'und'").collect()} == {None, "", " \n\t ", "½ ² 123"}


def test_shards(docs):
    slotted = stage(sharding.with_slots(docs), "rows")
    placed = sharding.place(slotted, sharding.build_map(sharding.slot_bytes(slotted))).collect()
    assert Counter(r.doc_id for r in placed) == Counter(i for i, _ in TEXTS.elements())
    assert len({(r.shard, r.slot) for r in placed}) == len(placed)


def test_quality(docs):
    out = quality.apply_host_rules(docs)
    assert out.columns == [*docs.columns, "rules_", "host_rules_", "kept_"] and carried(out) == TEXTS
    hosts = {r.source: r.host_rules_.n for r in out.collect()}
    assert hosts == {"s": sum(TEXTS.values()) - 3, None: 2, "t": 1}
    assert carried(quality.document_rules(docs)) == TEXTS


def test_tokens(docs):
    with open(tokens.RANKS, "rb") as f:
        enc = tokens.encoder(f.read())
    blocks, manifest = tokens.pack(docs)
    got = manifest.join(tokens.scan(blocks), ["file", "ordinal"], "left").collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len(enc.encode_ordinary(t)) if t else 0) for i, t in TEXTS.elements())


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(BIG + 9, ITEM, "x"), (BIG + 9, ITEM, "y"), (None, "", "x"), (4, None, "x")], "item_id long, text string, k string")
    assert [(r.doc_id, r.item_id, r.edits) for r in decontaminate.contamination(docs, bench).collect()] == [(BIG + 1, BIG + 9, 0)]
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and carried(kept) == TEXTS - Counter([(BIG + 1, f"{ITEM} and more")])


RECORD = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, digest string, headers map<string,string>, body string, at string, new string, part int"


def test_revisits(spark):
    def rec(i, url, ts, kind, tag=None, body=None):
        return (i, url, ts, kind, 200 if kind == "response" else 304, tag, None, None, None, body, "x", "y", 1)

    u = "http://a.com/"
    rows = [rec(BIG + 1, u, 1, "response", "t", "first"), rec(BIG + 1, u, 1, "response", "t", "first"), rec(None, u, 5, "response", "t", "no id"), rec(BIG + 3, u, 9, "revisit", "t"),
            rec(BIG + 3, u, 9, "revisit", "t"), rec(None, u, 9, "revisit", "t"), rec(4, None, 9, "revisit"), rec(5, u, None, "revisit"), rec(6, "", 3, "revisit")]
    got = warc.resolve_revisits(spark.createDataFrame(rows, RECORD)).collect()
    assert Counter((r.record_id, r.outcome, r.response_id, r.body) for r in got) == Counter({
        (BIG + 3, "resolved", BIG + 1, "first"): 2, (None, "missing", None, None): 1, (4, "missing", None, None): 1, (5, "missing", None, None): 1, (6, "missing", None, None): 1})


def test_a_hot_url_spreads_over_ranges(spark):
    rng = random.Random(3)
    rows = [(i, "http://hot.com/", 7, "response" if i % 50 == 0 else "revisit", 200, None, None, None, None, "b") for i in range(4000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, RECORD.split(", at string")[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    parts = [r["count"] for r in warc.in_ranges(df.withColumn("url_key", F.lit("hot"))).groupBy("part").count().collect()]
    assert len(parts) > 1 and max(parts) < 4000 * 0.8
    got = {r.record_id: r.response_id for r in warc.resolve_revisits(df).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: i // 50 * 50 for i in range(4000) if i % 50}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels, bench = spark.createDataFrame([], LABELS), spark.createDataFrame([], "item_id long, text string")
    slotted = stage(sharding.with_slots(none), "rows")
    blocks, manifest = tokens.pack(none)
    for out in (neardup.near_duplicates(none), neardup.keep_representatives(none), pieces.sample_encode(none.select("doc_id", "text")), secrets.scan(none), secrets.redact(none),
                toxicity.score(none, toxicity.fit_chain(none, labels)), toxicity.keep_clean(none, labels), language.predict(none, language.learn(none)),
                sharding.place(slotted, sharding.build_map(sharding.slot_bytes(slotted))), quality.apply_host_rules(none), manifest, tokens.scan(blocks),
                decontaminate.contamination(none, bench), decontaminate.keep_uncontaminated(none, bench), warc.resolve_revisits(spark.createDataFrame([], RECORD))):
        assert out.count() == 0


def test_the_pipeline_stages_alone(spark, tmp_path):
    """Each stage on its own input returns the columns of documents and drops what it must, and run() ends as the stages do."""
    import corpus_pipeline

    good = [" ".join(f"word{d}x{i}" for i in range(60)) for d in range(12)]
    texts = [*good, good[0], good[1] + " tail", f"{good[2]} {ITEM}", f"{good[3]} {SECRET} end", None, ""] + [f"{g} vile nasty" for g in good]
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], cols)
    # enough labelled rows for the words that mark toxic documents to be learned
    train = [(1000 + i, f"calm {i} text {i % 7}" + (" vile nasty" if i % 3 == 0 else ""), "en", "s", 5) for i in range(120)]
    every = docs.unionAll(spark.createDataFrame(train, cols))
    every.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 1000 % 3)) for i, *_ in train], LABELS).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "secrets", "sentencepiece"]
    alone = {name: f(spark, docs, str(tmp_path)) for name, f in stages.items() if name not in ("toxicity", "sentencepiece")}
    assert all(df.columns == docs.columns for df in alone.values())
    ids = {name: {r.doc_id for r in df.collect()} for name, df in alone.items()}
    n = len(good)
    assert ids["near_duplicates"] == set(range(len(texts))) - {n, n + 1} - {len(texts) - n + i for i in range(n)} - {n + 3}
    assert ids["decontamination"] == set(range(len(texts))) - {n + 2} and ids["secrets"] == set(range(len(texts)))
    assert alone["secrets"].where(f"doc_id = {n + 3}").first().text == f"{good[3]} [REDACTED] end"
    clean = stages["toxicity"](spark, every, str(tmp_path))
    toxic = {i for i, t in enumerate(texts) if t and "vile" in t} | {i for i, t, *_ in train if "vile" in t}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == (set(range(len(texts))) | {i for i, *_ in train}) - toxic
    # The whole: the stages' rules one after the other, by plain code on the clean documents.
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {r.doc_id: r for r in out if r["sample"] == 0}
    left = {i for i in range(len(texts)) if i not in toxic} - {n, n + 1, n + 2, n + 3}
    assert left <= set(got) and not set(got) & toxic and not set(got) & {n, n + 1, n + 2, n + 3}
    assert all(r.round_trip for r in out)
