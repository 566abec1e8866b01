"""The operators applied to the star-schema tables, each with its SQL.

Lines of orders stand for transactions: customers and suppliers are wallets, a supplier funds the
customer, lines of shipped orders also move a token. Every query runs over its whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import u256
from ..functions.ids import stable_id
from ..functions.staging import stage
from ..operators import canonical as C
from ..operators import evaluation as E
from ..operators import labels as L
from ..operators import resolution as R
from ..operators import state as ST
from ..operators import transfers as X
from ..sources import decode
from ..sources import seeds as seed_source
from . import api

DAYS30, FANOUT = 30 * 86400, 20
#: Supplier and part wallets are kept apart from customers'.
SUPPLIER, PART = 1 << 32, 1 << 33
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wallet(key):
    return F.concat(F.lit("0x"), F.lower(F.lpad(F.hex(key), 40, "0")))


def cents(c):
    return F.round(F.col(c) * 100).cast("long")


class Star:
    """The plans over the tables of one call; what several of them read is built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def lines(self) -> DataFrame:
        return ST.first_in_group(self.table("lineitem"), ["l_orderkey", "l_linenumber"], [F.desc(c) for c in LINE_ORDER])

    @cached_property
    def plain_rows(self) -> DataFrame:
        rows = self.lines.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return rows.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")

    @cached_property
    def shared_rows(self) -> DataFrame:
        """The deduplicated lines with their orders, staged: numbers only, hashes and addresses follow when they are read."""
        return stage(self.plain_rows, "facts")

    @property
    def facts(self) -> DataFrame:
        """From the staged rows where a plan of this call has needed them twice, else from the plan."""
        rows = self.__dict__.get("shared_rows", self.plain_rows)
        return rows.select(
            F.lit(1).cast("long").alias("chain_id"), F.col("o_orderkey").alias("block_number"),
            F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("block_hash"), F.col("o_orderdate").alias("block_timestamp"),
            F.concat(F.lit("0x"), F.sha2(F.concat_ws(":", "o_orderkey", "l_linenumber"), 256)).alias("tx_hash"), F.col("l_linenumber").cast("long").alias("tx_index"),
            wallet(F.col("l_suppkey") + SUPPLIER).alias("supplier"), wallet(F.col("o_custkey")).alias("customer"), wallet(F.col("l_partkey") + PART).alias("part"),
            F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).alias("status"),
            cents("l_quantity").alias("quantity"), cents("l_extendedprice").alias("price"), "l_linestatus", "o_orderstatus")

    def transactions(self) -> DataFrame:
        return self.facts.select("chain_id", "block_number", "block_hash", "block_timestamp", "tx_hash", "tx_index", F.col("supplier").alias("from_address"),
                                 F.col("customer").alias("to_address"), u256.from_long(F.col("quantity")).alias("value_wei"), "status")

    def transfers(self) -> DataFrame:
        return self.facts.where("l_linestatus = 'F'").select(
            "chain_id", "block_number", "block_hash", "block_timestamp", "tx_hash", (F.col("tx_index") + 100).alias("log_index"), F.col("part").alias("token_address"),
            F.col("customer").alias("from_address"), F.col("supplier").alias("to_address"), u256.from_long(F.col("price")).alias("amount_raw"))

    @cached_property
    def edges(self) -> DataFrame:
        self.shared_rows  # noqa: B018 - both kinds of edge read them
        return X.transfer_edges(self.transactions(), self.transfers())

    @cached_property
    def funding(self) -> DataFrame:
        """First funders, staged: every plan on them reads them more than once."""
        return stage(X.first_funders(X.native_edges(self.transactions())), "funding")

    @cached_property
    def pairs(self) -> DataFrame:
        return R.shared_funder_pairs(self.funding, DAYS30, FANOUT)

    @cached_property
    def members(self) -> DataFrame:
        return stage(R.clusters(R.island_components(self.funding, DAYS30, FANOUT), self.pairs), "members")

    @cached_property
    def stored(self) -> DataFrame:
        return R.stored_clusters(self.members)

    @cached_property
    def seeds(self) -> DataFrame:
        """Curated labels: customers in debt, an entity for each segment and nation."""
        category = F.create_map(*[F.lit(x) for pair in SEGMENTS for x in pair])[F.col("c_mktsegment")]
        return self.table("customer").where("c_acctbal < 0").select(
            F.lit(1).cast("long").alias("chain_id"), wallet(F.col("c_custkey")).alias("address"),
            F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("entity_name"), category.alias("entity_category"),
            F.when(F.col("c_acctbal") < -500, "hot_wallet").alias("contract_role"), F.lit("curated").alias("source_type"),
            F.concat(F.lit("customer "), F.col("c_custkey")).alias("source_reference"),
            ((F.pmod("c_custkey", F.lit(50)) + 50) / 100.0).alias("confidence"), F.lit("").alias("notes"))

    @cached_property
    def assignments(self) -> DataFrame:
        return stage(L.assignments(self.seeds, self.stored), "assignments")

    def predictions(self) -> DataFrame:
        return self.assignments.where("subject_type = 'address'").select(
            F.col("subject_id").alias("subject"), F.col("label_dimension").alias("dimension"), F.col("assignment_method").alias("method"), F.col("label_value").alias("value"))

    def drift(self) -> DataFrame:
        """The snapshot's metrics; fixed run counts and conflict count stand for the run row."""
        seen = self.funding.select(F.col("funded_address").alias("address"))
        return E.drift_metrics({"wallet_count": 100, "resolution_edge_count": 50}, self.stored, 7, self.assignments, 3, self.seeds, seen)


SEGMENTS = (("AUTOMOBILE", "dex"), ("BUILDING", "exchange"), ("FURNITURE", "bridge"), ("HOUSEHOLD", "protocol"), ("MACHINERY", "token_issuer"))


# SQL building blocks -------------------------------------------------------------------------


def sid(*parts: str) -> str:
    return "sha256(" + " || ".join(f"unhex(lpad(to_hex(strlen({p})), 16, '0')) || encode({p})" for p in parts) + ")"


def address_sql(key: str) -> str:
    return f"('0x' || lower(lpad(to_hex({key}), 40, '0')))"


def hex64(n: str) -> str:
    return f"lower(lpad(to_hex(CAST({n} AS BIGINT)), 64, '0'))"


def f32(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


def parts(*names: str) -> str:
    """WITH clause of the named blocks and those they build on, in order."""
    wanted, order = set(), list(BLOCKS)

    def need(n):
        if n not in wanted:
            wanted.add(n)
            for m in BLOCKS[n][0]:
                need(m)

    for n in names:
        need(n)
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n][1]})" for n in order if n in wanted) + "\n"


VALID = "customer <> '0x0000000000000000000000000000000000000000'"
BLOCKS = {
    "ln": ((), "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
           + ", ".join(f"{c} DESC" for c in LINE_ORDER) + ") AS rn FROM lineitem) WHERE rn = 1"),
    "fact": (("ln",), f"""SELECT CAST(1 AS BIGINT) AS chain_id, o_orderkey AS block_number, '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS block_hash,
        o_orderdate AS block_timestamp, '0x' || sha256(o_orderkey || ':' || l_linenumber) AS tx_hash, CAST(l_linenumber AS BIGINT) AS tx_index,
        {address_sql(f'l_suppkey + {SUPPLIER}')} AS supplier, {address_sql('o_custkey')} AS customer, {address_sql(f'l_partkey + {PART}')} AS part,
        CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END AS status, CAST(round(l_quantity * 100) AS BIGINT) AS quantity,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS price, l_linestatus FROM ln JOIN orders ON l_orderkey = o_orderkey"""),
    "native": (("fact",), f"""SELECT chain_id, {sid("CAST(chain_id AS VARCHAR)", "tx_hash", "'native'")} AS edge_id, block_number, block_hash, block_timestamp, tx_hash, tx_index,
        supplier AS from_address, customer AS to_address, 'native' AS asset_type, CAST(NULL AS VARCHAR) AS token_address, quantity AS amount
        FROM fact WHERE status IS DISTINCT FROM 0 AND quantity > 0 AND supplier <> customer AND {VALID}"""),
    "edge": (("native",), f"""SELECT * FROM native UNION ALL SELECT chain_id, {sid("CAST(chain_id AS VARCHAR)", "tx_hash", "CAST(tx_index + 100 AS VARCHAR)")}, block_number, block_hash,
        block_timestamp, tx_hash, tx_index + 100, customer, supplier, 'erc20', part, price FROM fact WHERE l_linestatus = 'F' AND price > 0 AND supplier <> customer AND {VALID}"""),
    "fund": (("native",), """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chain_id, to_address ORDER BY block_number, tx_index, tx_hash, edge_id) AS rn FROM native) WHERE rn = 1"""),
    "fan": (("fund",), f"""SELECT chain_id, from_address, count(DISTINCT to_address) AS fanout FROM fund GROUP BY 1, 2 HAVING count(DISTINCT to_address) BETWEEN 2 AND {FANOUT}"""),
    "pair": (("fan",), f"""SELECT *, least(1.0, 0.60 + 0.25 * greatest(0.0, 1.0 - delta / {DAYS30}.0::DOUBLE) + 0.15 * greatest(0.0, 1.0 - (fanout - 2) / {FANOUT - 2}.0::DOUBLE)) AS score,
        {sid("CAST(chain_id AS VARCHAR)", "'shared_funder'", "wallet_a", "wallet_b")} AS edge_id
        FROM (SELECT a.chain_id, a.to_address AS wallet_a, b.to_address AS wallet_b, a.from_address AS funder_address, fanout,
                     CAST(abs(epoch_us(a.block_timestamp) - epoch_us(b.block_timestamp)) // 1000000 AS BIGINT) AS delta
              FROM fund a JOIN fund b ON a.chain_id = b.chain_id AND a.from_address = b.from_address AND a.to_address < b.to_address
              JOIN fan ON fan.chain_id = a.chain_id AND fan.from_address = a.from_address) WHERE delta <= {DAYS30}"""),
    "link": (("pair",), "SELECT wallet_a AS a, wallet_b AS b FROM pair UNION SELECT wallet_b, wallet_a FROM pair"),
    "reach": (("link",), "SELECT a AS w, a AS v FROM link UNION SELECT reach.w, link.b FROM reach JOIN link ON reach.v = link.a"),
    "comp": (("reach",), "SELECT w AS wallet, min(v) AS root FROM reach GROUP BY w"),
    "grp": (("comp",), f"""SELECT root, list_sort(list(wallet)) AS wallets, count(*) AS n FROM comp GROUP BY root"""),
    "clus": (("grp", "pair"), """SELECT CAST(1 AS BIGINT) AS chain_id, sha256(list_reduce(list_prepend(unhex(lpad(to_hex(1), 16, '0')) || encode('1') || unhex(lpad(to_hex(7), 16, '0')) || encode('cluster'),
            list_transform(wallets, lambda x: unhex(lpad(to_hex(strlen(x)), 16, '0')) || encode(x))), lambda p, q: p || q)) AS cluster_id,
        unnest(wallets) AS wallet_address, CAST(n AS INTEGER) AS cluster_size,
        (SELECT min(score) FROM pair JOIN comp ON comp.wallet = pair.wallet_a WHERE comp.root = grp.root) AS confidence FROM grp"""),
    "memb": (("clus",), f"""SELECT chain_id, cluster_id, wallet_address, cluster_size, {f32('confidence')} AS confidence FROM clus"""),
    "seed": ((), f"""SELECT CAST(1 AS BIGINT) AS chain_id, {address_sql('c_custkey')} AS address, c_mktsegment || ' ' || c_nationkey AS entity_name,
        CASE c_mktsegment {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in SEGMENTS)} END AS entity_category,
        CASE WHEN c_acctbal < -500 THEN 'hot_wallet' END AS contract_role, 'curated' AS source_type, 'customer ' || c_custkey AS source_reference,
        (c_custkey % 50 + 50) / 100.0::DOUBLE AS confidence, lower(c_mktsegment || ' ' || c_nationkey) AS name FROM customer WHERE c_acctbal < 0"""),
    "named": (("seed",), f"""SELECT *, 'seed_' || {sid("CAST(chain_id AS VARCHAR)", "name")} AS entity_id, row_number() OVER (PARTITION BY name ORDER BY address) AS rn FROM seed"""),
    "cs": (("named", "memb"), """SELECT m.cluster_id, m.wallet_address, m.confidence AS member_confidence, s.* FROM memb m JOIN named s ON s.address = m.wallet_address"""),
    "sel": (("cs",), """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY confidence DESC, address) AS pick FROM cs
        WHERE cluster_id IN (SELECT cluster_id FROM cs GROUP BY 1 HAVING count(DISTINCT name) = 1)) WHERE pick = 1"""),
    "conf": (("cs",), """SELECT CAST(1 AS BIGINT) AS chain_id, cluster_id, 'conflicting_direct_seed_identities' AS conflict_type,
        '{"addresses":["' || array_to_string(list_sort(list(address)), '","') || '"],"entity_names":["' || array_to_string(list_sort(list(DISTINCT entity_name)), '","') || '"]}' AS details
        FROM cs GROUP BY cluster_id HAVING count(DISTINCT name) > 1"""),
    "cid": (("memb",), f"""SELECT DISTINCT cluster_id, 'cluster_' || {sid("'1'", "cluster_id")} AS entity_id FROM memb"""),
    "tgt": (("sel", "cid"), f"""SELECT t.*, cid.entity_id AS c_entity, greatest(0.0, least(1.0, t.confidence * t.mc * 0.95)) AS spread FROM (
        SELECT sel.cluster_id, sel.entity_category, sel.address AS seed_address, sel.confidence, sel.source_type, sel.source_reference, 'address' AS subject_type, m.wallet_address AS subject_id, m.confidence AS mc
        FROM sel JOIN memb m ON m.cluster_id = sel.cluster_id WHERE m.wallet_address NOT IN (SELECT address FROM seed)
        UNION ALL SELECT sel.cluster_id, sel.entity_category, sel.address, sel.confidence, sel.source_type, sel.source_reference, 'entity', cid.entity_id, sel.member_confidence
        FROM sel JOIN cid ON cid.cluster_id = sel.cluster_id) t JOIN cid ON cid.cluster_id = t.cluster_id"""),
    "dir": (("named",), """SELECT chain_id, 'entity' AS subject_type, entity_id AS subject_id, 'entity_category' AS label_dimension, entity_category AS label_value, * EXCLUDE (chain_id) FROM named WHERE rn = 1
        UNION ALL SELECT chain_id, 'address', address, 'entity_category', entity_category, * EXCLUDE (chain_id) FROM named
        UNION ALL SELECT chain_id, 'address', address, 'contract_role', contract_role, * EXCLUDE (chain_id) FROM named WHERE contract_role IS NOT NULL"""),
    "asg": (("dir", "tgt"), """SELECT chain_id, subject_type, subject_id, entity_id, label_dimension, label_value, confidence, 'direct_seed' AS assignment_method, source_type, source_reference, 'taxonomy_v1' AS taxonomy_version FROM dir
        UNION ALL SELECT 1, subject_type, subject_id, c_entity, 'entity_category', entity_category, spread, 'cluster_propagation', source_type, source_reference, 'taxonomy_v1' FROM tgt"""),
    "truth": (("seed",), """SELECT address AS subject, 'entity_category' AS dimension, entity_category AS truth FROM seed UNION ALL SELECT address, 'contract_role', contract_role FROM seed WHERE contract_role IS NOT NULL"""),
    "feat": (("edge",), "SELECT DISTINCT from_address AS address FROM edge UNION SELECT DISTINCT to_address FROM edge"),
    "csize": (("memb",), "SELECT cluster_id, count(*) AS n, min(confidence) AS c FROM memb GROUP BY 1"),
}


def with_(sql: str, *names: str) -> str:
    text = parts(*names)
    return (text.replace("WITH ", "WITH RECURSIVE ", 1) if "reach AS" in text else text) + sql


# State -----------------------------------------------------------------------------------------


@query(with_("SELECT * EXCLUDE (rn) FROM ln", "ln"))
def dedupe_latest(spark, sf_dir):
    return Star(spark, sf_dir).lines


@query("""SELECT user_id, s.event_type AS event_type, s.value AS value, s.ts AS ts, s.props AS props, v AS event_id
  FROM (SELECT user_id, arg_max({'event_type': event_type, 'value': value, 'ts': ts, 'props': props}, event_id) AS s, max(event_id) AS v FROM events GROUP BY user_id)""")
def latest_state(spark, sf_dir):
    return ST.latest_by_version(table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts", "props", "event_id"), ["user_id"], "event_id")


RUNS = """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_custkey AS chain_id, CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'running' END AS status,
  o_orderdate AS completed_at, CAST(1 AS BIGINT) AS version FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_custkey,
  CASE o_orderstatus WHEN 'P' THEN 'completed' ELSE 'failed' END, o_orderdate, 2 FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""


@query(f"""SELECT chain_id, s.run_id AS run_id, s.status AS status, s.completed_at AS completed_at, s.version AS version FROM (
  SELECT chain_id, arg_max({{'run_id': run_id, 'status': status, 'completed_at': completed_at, 'version': version}}, {{'t': completed_at, 'r': run_id}}) AS s
  FROM (SELECT r.* FROM ({RUNS}) r JOIN (SELECT run_id, max(version) AS version FROM ({RUNS}) GROUP BY 1) m USING (run_id, version)) WHERE status = 'completed' GROUP BY chain_id)""")
def latest_completed_run(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    base = [F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_custkey").alias("chain_id")]
    one = o.select(*base, F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"), F.col("o_orderdate").alias("completed_at"), F.lit(1).cast("long").alias("version"))
    two = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        *base, F.when(F.col("o_orderstatus") == "P", "completed").otherwise("failed").alias("status"), F.col("o_orderdate").alias("completed_at"), F.lit(2).cast("long").alias("version"))
    return ST.latest_completed(one.unionByName(two), ["chain_id"])


CANON = "SELECT CAST(1 AS BIGINT) AS chain_id, o_custkey AS block_number, '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS block_hash, o_orderkey AS version, o_orderstatus, o_totalprice FROM orders"


def canon(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit(1).cast("long").alias("chain_id"), F.col("o_custkey").alias("block_number"),
        F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("block_hash"), F.col("o_orderkey").alias("version"), "o_orderstatus", "o_totalprice")


@query(f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY block_number ORDER BY version DESC) AS rn FROM ({CANON})) WHERE rn = 1")
def canonical_blocks(spark, sf_dir):
    return C.current_blocks(canon(spark, sf_dir))


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey AS block_number FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE (o_custkey, o_orderkey) IN (SELECT (block_number, version) FROM (SELECT block_number, max(version) AS version FROM ({CANON}) GROUP BY 1))""")
def canonical_facts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.lit(1).cast("long").alias("chain_id"), F.col("o_custkey").alias("block_number"), F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("block_hash"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return C.canonical_facts(rows, C.current_blocks(canon(spark, sf_dir))).drop("chain_id", "block_hash")


@query("""SELECT CAST(1 AS BIGINT) AS chain_id, o_custkey AS block_number, '0x' || sha256(o_orderstatus) AS block_hash, '0x' || sha256(o_orderpriority) AS parent_hash,
  max(o_orderdate) AS last_ingested_at FROM orders GROUP BY 1, 2, 3, 4""")
def observed_forks(spark, sf_dir):
    h = lambda c: F.concat(F.lit("0x"), F.sha2(c, 256))
    return C.observed_forks(table(spark, sf_dir, "orders").select(
        F.lit(1).cast("long").alias("chain_id"), F.col("o_custkey").alias("block_number"), h("o_orderstatus").alias("block_hash"), h("o_orderpriority").alias("parent_hash"),
        F.col("o_orderdate").alias("ingested_at")))


#: A chain per priority; above each chain's fork height the remote hashes differ.
FORK = """cur AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS chain_id, o_orderkey AS block_number, 'c' || o_orderkey AS block_hash, 'c' || (o_orderkey - 1) AS parent_hash FROM orders),
top AS (SELECT chain_id, max(block_number) AS head FROM cur GROUP BY 1),
rem AS (SELECT cur.chain_id, block_number, CASE WHEN block_number > head - 60 THEN 'r' || block_number ELSE upper(block_hash) END AS block_hash,
  CASE WHEN block_number - 1 > head - 60 THEN 'r' ELSE 'c' END || (block_number - 1) AS parent_hash FROM cur JOIN top USING (chain_id) WHERE block_number < head - 3),
anc AS (SELECT chain_id, max(block_number) AS ancestor FROM cur JOIN rem USING (chain_id, block_number) WHERE lower(cur.block_hash) = lower(rem.block_hash) GROUP BY 1),
nh AS (SELECT chain_id, max(block_number) AS new_head FROM rem GROUP BY 1)"""


def forked(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    n = F.col("block_number")
    text = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    cur = table(spark, sf_dir, "orders").select(F.substring("o_orderpriority", 1, 1).cast("long").alias("chain_id"), F.col("o_orderkey").alias("block_number")).withColumns(
        {"block_hash": text("c", n), "parent_hash": text("c", n - 1)})
    top = F.broadcast(cur.groupBy("chain_id").agg(F.max("block_number").alias("head")))  # a row a chain
    rem = cur.join(top, "chain_id").where("block_number < head - 3").select(
        "chain_id", "block_number", F.when(n > F.col("head") - 60, text("r", n)).otherwise(F.upper("block_hash")).alias("block_hash"),
        F.when(n - 1 > F.col("head") - 60, text("r", n - 1)).otherwise(text("c", n - 1)).alias("parent_hash"))
    return rem, cur


@query(f"""WITH {FORK} SELECT chain_id, block_number, block_hash, parent_hash, 'reorg_orphaned' AS reason FROM cur JOIN anc USING (chain_id) WHERE block_number > ancestor
  UNION ALL SELECT chain_id, block_number, block_hash, parent_hash, 'reorg_replacement' FROM rem JOIN anc USING (chain_id) WHERE block_number > ancestor""")
def reorg_plan(spark, sf_dir):
    return C.reorg_plan(*forked(spark, sf_dir), max_depth=1000)


@query(f"""WITH {FORK}, o AS (SELECT chain_id, count(*) AS n, arg_max(block_hash, block_number) AS h, max(block_number) AS b FROM cur JOIN anc USING (chain_id) WHERE block_number > ancestor GROUP BY 1),
  r AS (SELECT chain_id, count(*) AS n, arg_max(block_hash, block_number) AS h, max(block_number) AS b FROM rem JOIN anc USING (chain_id) WHERE block_number > ancestor GROUP BY 1),
  f AS (SELECT chain_id, min(block_number) - 1 AS a FROM (SELECT chain_id, block_number FROM cur UNION ALL SELECT chain_id, block_number FROM rem) JOIN anc USING (chain_id) WHERE block_number > ancestor GROUP BY 1)
  SELECT chain_id, o.b AS old_head_block, o.h AS old_head_hash, r.b AS new_head_block, r.h AS new_head_hash, f.a AS common_ancestor_block, o.n AS orphaned_block_count, r.n AS replacement_block_count
  FROM o JOIN r USING (chain_id) JOIN f USING (chain_id)""")
def reorg_event(spark, sf_dir):
    return C.reorg_event(C.reorg_plan(*forked(spark, sf_dir), max_depth=1000))


@query(f"""WITH {FORK} SELECT r.chain_id, r.block_number, coalesce(lower(c.block_hash) <> lower(r.block_hash), false) AS hash_differs, coalesce(lower(p.block_hash) <> lower(r.parent_hash), false) AS parent_differs
  FROM rem r LEFT JOIN cur c USING (chain_id, block_number) LEFT JOIN cur p ON p.chain_id = r.chain_id AND p.block_number = r.block_number - 1
  WHERE coalesce(lower(c.block_hash) <> lower(r.block_hash), false) OR coalesce(lower(p.block_hash) <> lower(r.parent_hash), false)""")
def reorg_conflicts(spark, sf_dir):
    return C.reorg_conflicts(*forked(spark, sf_dir)).select("chain_id", "block_number", "hash_differs", "parent_differs")


LEVELS = (("O", "unsafe"), ("P", "safe"), ("F", "finalized"))


@query("""WITH t AS (SELECT max(o_orderkey) * 8 // 10 AS safe, max(o_orderkey) * 5 // 10 AS finalized FROM orders),
  c AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 END AS old, CASE WHEN o_orderkey <= finalized THEN 3 WHEN o_orderkey <= safe THEN 2 ELSE 1 END AS new FROM orders, t)
  SELECT CAST(1 AS BIGINT) AS chain_id, o_orderkey AS block_number, 'c' || o_orderkey AS block_hash, 'c' || (o_orderkey - 1) AS parent_hash,
    CASE new WHEN 3 THEN 'finalized' ELSE 'safe' END AS security_level, CAST(2 AS BIGINT) AS version FROM c WHERE new > old""")
def finality_upgrades(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    level = F.create_map(*[F.lit(x) for p in LEVELS for x in p])[F.col("o_orderstatus")]
    cur = o.select(F.lit(1).cast("long").alias("chain_id"), F.col("o_orderkey").alias("block_number"), F.concat(F.lit("c"), "o_orderkey").alias("block_hash"),
                   F.concat(F.lit("c"), (F.col("o_orderkey") - 1).cast("string")).alias("parent_hash"), level.alias("security_level"), F.lit(1).cast("long").alias("version"))
    heads = o.agg(F.expr("max(o_orderkey) * 8 div 10").alias("safe"), F.expr("max(o_orderkey) * 5 div 10").alias("finalized")).withColumn("chain_id", F.lit(1).cast("long"))
    return C.finality_upgrades(cur, heads)


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment, CAST(CASE WHEN c_nationkey > 12 THEN 1 ELSE 4 END AS BIGINT) AS version
  FROM customer WHERE c_nationkey > 12 OR c_acctbal < 0""")
def state_upserts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    current = c.where("c_nationkey <= 12").select("c_custkey", "c_mktsegment", F.lit(3).cast("long").alias("version"))
    wanted = c.select("c_custkey", F.when(F.col("c_acctbal") < 0, "DEBT").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return ST.next_versions(current, wanted, ["c_custkey"], ["c_mktsegment"])


@query("""SELECT e.user_id, e.event_id, coalesce(h.last, 0) + row_number() OVER (PARTITION BY e.user_id ORDER BY e.event_id) AS sequence
  FROM (SELECT * FROM events WHERE event_type <> 'view') e LEFT JOIN (SELECT user_id, count(*) AS last FROM events WHERE event_type = 'view' GROUP BY 1) h USING (user_id)""")
def history_sequences(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    history = e.where("event_type = 'view'").groupBy("user_id").agg(F.count("*").alias("sequence"))
    return ST.next_sequences(history, e.where("event_type <> 'view'").drop("event_type"), ["user_id"], ["event_id"])


# Transfers and clusters --------------------------------------------------------------------------


@query(with_(f"SELECT * EXCLUDE (amount), {hex64('amount')} AS amount_raw FROM edge", "edge"))
def transfer_edges(spark, sf_dir):
    return Star(spark, sf_dir).edges


@query(with_(f"""SELECT chain_id, to_address AS funded_address, from_address AS funder_address, tx_hash AS funding_tx_hash, block_number AS funding_block_number, block_hash AS funding_block_hash,
  block_timestamp AS funding_timestamp, {hex64('amount')} AS amount_wei, 'first_native_funder' AS heuristic, 0.7::DOUBLE AS confidence FROM fund""", "fund"))
def first_funder(spark, sf_dir):
    return Star(spark, sf_dir).funding


FEATURES = f""", e AS (SELECT chain_id, from_address AS w, to_address AS o, true AS sent, * FROM edge UNION ALL SELECT chain_id, to_address, from_address, false, * FROM edge)
  SELECT e.chain_id, w AS wallet_address, min(e.block_number) AS first_seen_block, max(e.block_number) AS last_seen_block,
    count(*) FILTER (asset_type = 'native' AND NOT sent) AS incoming_native_tx_count, count(*) FILTER (asset_type = 'native' AND sent) AS outgoing_native_tx_count,
    count(*) FILTER (asset_type <> 'native' AND NOT sent) AS incoming_erc20_transfer_count, count(*) FILTER (asset_type <> 'native' AND sent) AS outgoing_erc20_transfer_count,
    count(DISTINCT o) AS unique_counterparties, {hex64("coalesce(sum(amount) FILTER (asset_type = 'native' AND NOT sent), 0)")} AS native_received_wei,
    {hex64("coalesce(sum(amount) FILTER (asset_type = 'native' AND sent), 0)")} AS native_sent_wei, any_value(f.from_address) AS first_funder_address, any_value(f.block_number) AS first_funding_block
  FROM e LEFT JOIN (SELECT to_address AS ft, from_address, block_number FROM fund) f ON f.ft = w GROUP BY 1, 2"""


@query(with_(FEATURES, "edge", "fund"))
def wallet_features(spark, sf_dir):
    star = Star(spark, sf_dir)
    return X.wallet_features(star.edges, star.funding)


PAIR_COLUMNS = "chain_id, wallet_a, wallet_b, 'shared_funder' AS heuristic, score, CAST(3 AS INTEGER) AS evidence_count, edge_id, funder_address, delta AS delta_seconds, fanout"


@query(with_(f"SELECT {PAIR_COLUMNS} FROM pair", "pair"))
def shared_funder_pairs(spark, sf_dir):
    return Star(spark, sf_dir).pairs


EVIDENCE = f"""SELECT chain_id, wallet_a, wallet_b, 'shared_funder' AS heuristic, 'same_first_funder' AS evidence_type, funder_address AS evidence_value, 0.60::DOUBLE AS weight, 0.60::DOUBLE AS score_contribution FROM pair
  UNION ALL SELECT chain_id, wallet_a, wallet_b, 'shared_funder', 'funding_time_delta_seconds', CAST(delta AS VARCHAR), 0.25, 0.25 * greatest(0.0, 1.0 - delta / {DAYS30}.0::DOUBLE) FROM pair
  UNION ALL SELECT chain_id, wallet_a, wallet_b, 'shared_funder', 'funder_fanout', CAST(fanout AS VARCHAR), 0.15, 0.15 * greatest(0.0, 1.0 - (fanout - 2) / {FANOUT - 2}.0::DOUBLE) FROM pair"""


@query(with_(EVIDENCE, "pair"))
def resolution_evidence(spark, sf_dir):
    return R.resolution_evidence(Star(spark, sf_dir).pairs, DAYS30, FANOUT)


@query(with_("SELECT CAST(1 AS BIGINT) AS chain_id, wallet, root FROM comp", "comp"))
def components(spark, sf_dir):
    return R.island_components(Star(spark, sf_dir).funding, DAYS30, FANOUT)


@query(with_("SELECT CAST(1 AS BIGINT) AS chain_id, wallet, root FROM comp", "comp"))
def components_iterative(spark, sf_dir):
    return R.edge_components(Star(spark, sf_dir).pairs)


@query(with_("SELECT *, 'shared_funder_v1' AS heuristic_version FROM clus", "clus"))
def clusters(spark, sf_dir):
    return Star(spark, sf_dir).members


@query(with_("SELECT from_address AS funder_address, count(DISTINCT to_address) AS funded FROM fund GROUP BY 1 ORDER BY funded DESC, funder_address LIMIT 20", "fund"))
def top_funders(spark, sf_dir):
    return Star(spark, sf_dir).funding.groupBy("funder_address").agg(F.countDistinct("funded_address").alias("funded")).orderBy(F.desc("funded"), "funder_address").limit(20)


@query("""SELECT l_returnflag, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS VARCHAR) AS total, lower(lpad(to_hex(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT)), 64, '0')) AS total_hex
  FROM lineitem GROUP BY 1""")
def u256_sum(spark, sf_dir):
    out = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(u256.sum_(u256.from_long(cents("l_extendedprice"))).alias("total_hex"))
    return out.withColumn("total", u256.to_decimal(F.col("total_hex")))


@query(with_(f"""SELECT tx_hash, part AS token_address, customer AS from_address, supplier AS to_address, {hex64('price')} AS amount_raw, tx_index + 100 AS log_index
  FROM fact WHERE l_linestatus = 'F' AND status IS NOT NULL""", "fact"))
def decode_transfers(spark, sf_dir):
    pad = lambda c: F.concat(F.lit("0x" + "0" * 24), F.upper(F.substring(c, 3, 40)))
    f = Star(spark, sf_dir).facts
    log = F.struct(F.upper(F.col("part")).alias("address"), F.array(F.upper(F.lit(decode.TRANSFER_TOPIC)), pad("customer"), pad("supplier")).alias("topics"),
                   F.concat(F.lit("0x"), u256.from_long(F.col("price"))).alias("data"), F.concat(F.lit("0x"), F.hex(F.col("tx_index") + 100)).alias("logIndex"),
                   F.col("status").isNull().alias("removed"))
    logs = f.where("l_linestatus = 'F'").select("tx_hash", log.alias("log")).withColumn(
        "log", F.col("log").withField("topics", F.transform("log.topics", lambda x: F.regexp_replace(x, "^0X", "0x"))).withField("address", F.regexp_replace("log.address", "^0X", "0x")))
    return logs.select("tx_hash", decode.decoded_transfer(F.col("log")).alias("x")).where("x IS NOT NULL").select("tx_hash", "x.*")


def captured(star: Star) -> DataFrame:
    """Blocks and receipts as a node tells them: JSON with hex quantities, an order a block."""
    h = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    # a sent transaction's status is 1, a failed one's 0; a null status is left out of the receipt
    tx = F.struct(F.col("tx_hash").alias("hash"), h(F.col("tx_index")).alias("transactionIndex"),
                  F.concat(F.lit("0x"), F.upper(F.substring("supplier", 3, 40))).alias("from"), F.when(F.col("quantity") % 7 != 0, F.col("customer")).alias("to"),
                  h(F.col("quantity")).alias("value"), F.lit("0x5208").alias("gas"), h(F.col("tx_index") + 1).alias("gasPrice"), F.lit("0xAb").alias("input"))
    pad = lambda c: F.concat(F.lit("0x" + "0" * 24), F.substring(c, 3, 40))
    log = F.struct(F.col("part").alias("address"), F.array(F.lit(decode.TRANSFER_TOPIC), pad("customer"), pad("supplier")).alias("topics"),
                   F.concat(F.lit("0x"), u256.from_long(F.col("price"))).alias("data"), h(F.col("tx_index") + 100).alias("logIndex"))
    receipt = F.struct(F.col("tx_hash").alias("transactionHash"), F.col("block_hash").alias("blockHash"), h(F.col("status")).alias("status"),
                       F.when(F.col("l_linestatus") == "F", F.array(log)).otherwise(F.array()).alias("logs"))
    blocks = star.facts.groupBy("block_number", "block_hash", "block_timestamp").agg(  # a few lines an order
        F.sort_array(F.collect_list(F.struct("tx_index", tx.alias("t"), receipt.alias("r")))).alias("x"))
    block = F.struct(h(F.col("block_number")).alias("number"), F.col("block_hash").alias("hash"), F.col("block_hash").alias("parentHash"),
                     h(F.unix_seconds(F.col("block_timestamp").cast("timestamp"))).alias("timestamp"), F.col("x.t").alias("transactions"))
    return blocks.select(F.lit(1).cast("long").alias("chain_id"), F.to_json(block).alias("block"), F.to_json("x.r").alias("receipts"), F.lit(None).cast("timestamp").alias("ingested_at"))


def timed(df: DataFrame) -> DataFrame:
    """Times as the tables have them, without a zone."""
    return df.withColumn("block_timestamp", F.col("block_timestamp").cast("timestamp_ntz"))


@query(with_("""SELECT chain_id, block_number, block_hash, block_hash AS parent_hash, date_trunc('second', block_timestamp) AS block_timestamp, CAST(count(*) AS INTEGER) AS transaction_count
  FROM fact GROUP BY 1, 2, 3, 4, 5""", "fact"))
def decode_blocks(spark, sf_dir):
    return timed(decode.raw_blocks(decode.parsed(captured(Star(spark, sf_dir)))).drop("ingested_at"))


@query(with_(f"""SELECT chain_id, block_number, block_hash, date_trunc('second', block_timestamp) AS block_timestamp, tx_hash, tx_index, supplier AS from_address,
  CASE WHEN quantity % 7 <> 0 THEN customer END AS to_address, {hex64('quantity')} AS value_wei, CAST(21000 AS BIGINT) AS gas, {hex64('tx_index + 1')} AS gas_price, '0xab' AS input,
  CAST(status AS BIGINT) AS status FROM fact""", "fact"))
def decode_transactions(spark, sf_dir):
    return timed(decode.raw_transactions(decode.parsed(captured(Star(spark, sf_dir)))).drop("ingested_at"))


@query(with_(f"""SELECT chain_id, block_number, block_hash, date_trunc('second', block_timestamp) AS block_timestamp, tx_hash, tx_index + 100 AS log_index, part AS token_address,
  customer AS from_address, supplier AS to_address, {hex64('price')} AS amount_raw FROM fact WHERE l_linestatus = 'F'""", "fact"))
def decode_block_transfers(spark, sf_dir):
    return timed(decode.token_transfers(decode.parsed(captured(Star(spark, sf_dir)))).drop("ingested_at"))


@query("""SELECT 'sha256:' || sha256('[' || string_agg('{"address":"' || address || '","chain_id":1,"confidence":"0.5","contract_role":"","entity_category":"dex","entity_name":"' || n_name
  || '","notes":"","source_reference":"nation ' || n_nationkey || '","source_type":"curated"}', ',' ORDER BY address) || ']') AS digest
  FROM (SELECT *, '0x' || lower(lpad(to_hex(n_nationkey + 1), 40, '0')) AS address FROM nation)""")
def seed_digest(spark, sf_dir):
    """The version of a seed list made of the 25 nations; the list goes through the reader's checks."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()  # a fixed table
    lines = [f"1,0x{r.n_nationkey + 1:040X},  {r.n_name} ,DEX,,Curated,nation {r.n_nationkey},0.5," for r in n]
    return spark.createDataFrame([(seed_source.digest(seed_source.parse("\n".join([",".join(seed_source.HEADER), *lines]))),)], "digest string")


@query("SELECT p_partkey, " + sid("CAST(p_partkey AS VARCHAR)", "p_name", "'part'") + " AS id FROM part")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", stable_id(F.col("p_partkey"), F.col("p_name"), "part").alias("id"))


# Labels ------------------------------------------------------------------------------------------


@query(with_("""SELECT chain_id, entity_id, entity_name AS display_name, entity_category, 'direct_seed' AS created_from, CAST(NULL AS VARCHAR) AS cluster_id FROM named WHERE rn = 1
  UNION ALL SELECT CAST(1 AS BIGINT), cid.entity_id, sel.entity_name, coalesce(sel.entity_category, 'unknown'), 'cluster_membership', cid.cluster_id FROM cid LEFT JOIN sel ON sel.cluster_id = cid.cluster_id""", "named", "sel", "cid"))
def entities(spark, sf_dir):
    star = Star(spark, sf_dir)
    return L.entities(star.seeds, star.stored)


@query(with_("""SELECT chain_id, entity_id, address AS wallet_address, 'direct_seed' AS membership_method, confidence AS membership_confidence, CAST(NULL AS VARCHAR) AS cluster_id FROM named
  UNION ALL SELECT chain_id, entity_id, wallet_address, 'cluster_membership', confidence, m.cluster_id FROM memb m JOIN cid ON cid.cluster_id = m.cluster_id""", "named", "cid"))
def entity_members(spark, sf_dir):
    star = Star(spark, sf_dir)
    return L.entity_members(star.seeds, star.stored)


@query(with_("SELECT * FROM asg WHERE assignment_method = 'direct_seed'", "asg"))
def direct_labels(spark, sf_dir):
    star = Star(spark, sf_dir)
    return L.assignments(star.seeds, star.stored).where("assignment_method = 'direct_seed'")


@query(with_("SELECT * FROM asg WHERE assignment_method = 'cluster_propagation'", "asg"))
def propagated_labels(spark, sf_dir):
    star = Star(spark, sf_dir)
    return L.assignments(star.seeds, star.stored).where("assignment_method = 'cluster_propagation'")


@query(with_("SELECT * FROM conf", "conf"))
def label_conflicts(spark, sf_dir):
    star = Star(spark, sf_dir)
    return L.conflicts(star.seeds, star.stored)


@query(with_("""SELECT chain_id, subject_type, subject_id, label_dimension, label_value, 'curated_seed' AS evidence_type, 'curated label for ' || address AS evidence_value, 1.0::DOUBLE AS weight,
    confidence AS confidence_contribution, source_type, source_reference FROM dir
  UNION ALL SELECT 1, subject_type, subject_id, 'entity_category', entity_category, 'labeled_cluster_member', seed_address, confidence, confidence, source_type, source_reference FROM tgt
  UNION ALL SELECT 1, subject_type, subject_id, 'entity_category', entity_category, 'cluster_membership_confidence', printf('%.17g', mc), mc, mc, source_type, source_reference FROM tgt
  UNION ALL SELECT 1, subject_type, subject_id, 'entity_category', entity_category, 'propagation_factor', printf('%.17g', 0.95::DOUBLE), 0.95, 0.95, source_type, source_reference FROM tgt""", "dir", "tgt"))
def label_evidence(spark, sf_dir):
    star = Star(spark, sf_dir)
    return L.label_evidence(star.seeds, star.stored)


# Evaluation --------------------------------------------------------------------------------------


PRF = """CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) END AS {p}, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END AS {r},
  CASE WHEN tp > 0 THEN 2 * (tp::DOUBLE / (tp + fp)) * (tp::DOUBLE / (tp + fn)) / (tp::DOUBLE / (tp + fp) + tp::DOUBLE / (tp + fn)) END AS {f}"""
EVALUATED = f""", spk AS (SELECT dimension, method, subject, max(value) AS value FROM pred GROUP BY 1, 2, 3),
  met AS (SELECT unnest({{methods}}) AS method),
  val AS (SELECT DISTINCT t.dimension, method, truth AS label FROM truth t, met UNION SELECT p.dimension, p.method, p.value FROM pred p JOIN truth t ON t.dimension = p.dimension AND t.subject = p.subject),
  c AS (SELECT v.*, (SELECT count(*) FROM truth t LEFT JOIN spk s ON s.subject = t.subject AND s.dimension = t.dimension AND s.method = v.method WHERE t.dimension = v.dimension AND t.truth = v.label AND s.value = v.label) AS tp,
      (SELECT count(*) FROM truth t JOIN spk s ON s.subject = t.subject AND s.dimension = t.dimension AND s.method = v.method WHERE t.dimension = v.dimension AND t.truth <> v.label AND s.value = v.label) AS fp,
      (SELECT count(*) FROM truth t WHERE t.dimension = v.dimension AND t.truth = v.label) AS support,
      (SELECT count(*) FROM pred p WHERE p.dimension = v.dimension AND p.method = v.method AND p.value = v.label) AS predicted_count,
      (SELECT count(s.subject)::DOUBLE / count(*) FROM truth t LEFT JOIN spk s ON s.subject = t.subject AND s.dimension = t.dimension AND s.method = v.method WHERE t.dimension = v.dimension) AS coverage FROM val v),
  d AS (SELECT *, support - tp AS fn FROM c)
  SELECT dimension AS label_dimension, label AS label_value, method AS assignment_method, tp, fp, fn, {PRF.format(p='precision', r='recall', f='f1')}, support, predicted_count, coverage FROM d"""


@query(with_(", pred AS (SELECT subject_id AS subject, label_dimension AS dimension, assignment_method AS method, label_value AS value FROM asg WHERE subject_type = 'address')"
             + EVALUATED.replace("{methods}", "['direct_seed', 'cluster_propagation']"), "truth", "asg"))
def label_evaluation(spark, sf_dir):
    star = Star(spark, sf_dir)
    return E.evaluate_labels(E.truth_labels(star.seeds), star.predictions())


@query("""WITH truth AS (SELECT c_custkey AS subject, 'balance' AS dimension, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS truth FROM customer),
  pred AS (SELECT c_custkey AS subject, 'balance' AS dimension, 'rule' AS method, CASE WHEN c_mktsegment = 'BUILDING' THEN 'debt' ELSE 'credit' END AS value FROM customer WHERE c_nationkey < 20)"""
       + EVALUATED.replace("{methods}", "['rule']"))
def customer_rule_evaluation(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    own = [F.col("c_custkey").alias("subject"), F.lit("balance").alias("dimension")]
    truth = c.select(*own, F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("truth"))
    rule = F.when(F.col("c_mktsegment") == "BUILDING", "debt").otherwise("credit")
    return E.evaluate_labels(truth, c.where("c_nationkey < 20").select(*own, F.lit("rule").alias("method"), rule.alias("value")), ("rule",))


@query(with_(f""", t AS (SELECT address, name AS entity, cluster_id FROM seed LEFT JOIN memb ON wallet_address = address WHERE address IN (SELECT address FROM feat)),
  p AS (SELECT count(*) FILTER (a.cluster_id = b.cluster_id AND a.entity = b.entity) AS tp, count(*) FILTER (a.cluster_id = b.cluster_id AND a.entity <> b.entity) AS fp,
    count(*) FILTER (a.cluster_id IS DISTINCT FROM b.cluster_id AND a.entity = b.entity OR a.cluster_id IS NULL AND a.entity = b.entity) AS fn FROM t a JOIN t b ON a.address < b.address)
  SELECT 'curated_entities_seen_in_cluster_scope' AS metric_scope, tp AS tp_pairs, fp AS fp_pairs, fn AS fn_pairs, {PRF.format(p='pairwise_precision', r='pairwise_recall', f='pairwise_f1')},
    (SELECT count(DISTINCT entity) FROM t) AS ground_truth_entity_count, (SELECT count(*) FROM seed) AS ground_truth_address_count, (SELECT count(*) FROM t) AS evaluated_address_count,
    (SELECT count(DISTINCT cluster_id) FROM t) AS predicted_cluster_count FROM p""", "seed", "memb", "feat"))
def clustering_evaluation(spark, sf_dir):
    star = Star(spark, sf_dir)
    seen = star.edges.select(F.explode(F.array("from_address", "to_address")).alias("address")).distinct()
    return E.evaluate_clustering(star.seeds.select("address", F.col("entity_name").alias("entity")), seen,
                                 star.stored.select(F.col("wallet_address").alias("address"), "cluster_id"))


SIZES_SQL = """count(*)::DOUBLE AS cluster_count, coalesce(max(n), 0)::DOUBLE AS largest_cluster_size, coalesce(avg(n), 0)::DOUBLE AS average_cluster_size,
  coalesce(median(n), 0)::DOUBLE AS median_cluster_size, coalesce(quantile_disc(n, 0.95), 0)::DOUBLE AS p95_cluster_size"""


@query(f"SELECT {SIZES_SQL}, coalesce(avg(c), 0)::DOUBLE AS average_cluster_confidence FROM (SELECT user_id, count(*) AS n, 0.5::DOUBLE AS c FROM events GROUP BY 1)")
def size_statistics(spark, sf_dir):
    return E.size_statistics(table(spark, sf_dir, "events").select(F.col("user_id").alias("cluster_id"), F.lit(0.5).alias("confidence")))


DRIFT = f""", z AS (SELECT {SIZES_SQL}, coalesce(avg(c), 0)::DOUBLE AS average_cluster_confidence FROM csize),
  own AS (SELECT DISTINCT address FROM seed),
  dm AS (SELECT 'clustering' AS metric_group, 'wallet_count' AS metric_name, 'all' AS scope_key, 100.0::DOUBLE AS value UNION ALL SELECT 'clustering', 'resolution_edge_count', 'all', 50.0
  UNION ALL SELECT 'clustering', unnest(['cluster_count', 'largest_cluster_size', 'average_cluster_size', 'median_cluster_size', 'p95_cluster_size', 'average_cluster_confidence']), 'all',
    unnest([cluster_count, largest_cluster_size, average_cluster_size, median_cluster_size, p95_cluster_size, average_cluster_confidence]) FROM z
  UNION ALL SELECT 'labels', 'entity_count', 'all', 7.0 UNION ALL SELECT 'labels', 'conflict_count', 'all', 3.0
  UNION ALL SELECT 'labels', 'direct_label_count', 'all', count(*) FROM asg WHERE assignment_method = 'direct_seed'
  UNION ALL SELECT 'labels', 'propagated_label_count', 'all', count(*) FROM asg WHERE assignment_method = 'cluster_propagation'
  UNION ALL SELECT 'labels', 'average_propagated_confidence', 'all', round(coalesce(avg(confidence), 0), 9) FROM asg WHERE assignment_method = 'cluster_propagation'
  UNION ALL SELECT 'coverage', 'seed_count', 'all', count(*) FROM own
  UNION ALL SELECT 'coverage', 'seed_seen_count', 'all', count(*) FROM own WHERE address IN (SELECT to_address FROM fund)
  UNION ALL SELECT 'coverage', 'seed_cluster_overlap_count', 'all', count(*) FROM own WHERE address IN (SELECT wallet_address FROM memb)
  UNION ALL SELECT 'coverage', 'ground_truth_addresses_directly_labeled', 'all', count(*) FROM own WHERE address IN (SELECT subject_id FROM asg WHERE assignment_method = 'direct_seed')
  UNION ALL SELECT 'coverage', 'ground_truth_addresses_with_inferred_labels', 'all', count(*) FROM own WHERE address IN (SELECT subject_id FROM asg WHERE assignment_method = 'cluster_propagation')
  UNION ALL SELECT 'labels', 'label_count', label_dimension || '=' || label_value, count(*) FROM asg GROUP BY 3)"""


@query(with_(DRIFT + " SELECT * REPLACE (round(value, 9) AS value) FROM dm", "csize", "asg", "seed", "fund"))
def drift_metrics(spark, sf_dir):
    return Star(spark, sf_dir).drift().withColumn("value", F.round("value", 9))


MONTHS = """month AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS m, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2),
  dm AS (SELECT m, unnest(['largest_cluster_size', 'cluster_count', 'wallet_count', 'propagated_label_count', 'conflict_count', 'seed_seen_count', 'seed_cluster_overlap_count']) AS metric_name,
    unnest([max(n), count(*), sum(n) // 40, sum(n) % 7, sum(n) % 3, count(*) // 10, sum(n) // 12]::DOUBLE[]) AS value FROM month GROUP BY m),
  cmp AS (SELECT a.m, 'g' AS metric_group, a.metric_name, 'all' AS scope_key, a.value, b.value AS previous_value, a.value - b.value AS absolute_change,
    CASE WHEN b.value <> 0 THEN (a.value - b.value) / abs(b.value) END AS relative_change FROM dm a LEFT JOIN dm b ON b.m = a.m - 1 AND b.metric_name = a.metric_name)"""


def monthly(spark, sf_dir) -> DataFrame:
    """Order metrics by month against the month before, under the watched names."""
    m = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long")
    per = table(spark, sf_dir, "orders").groupBy(m.alias("m"), "o_custkey").agg(F.count("*").alias("n"))
    total = F.col("s")
    wide = per.groupBy("m").agg(F.max("n").alias("x"), F.count("*").alias("c"), F.sum("n").alias("s"))
    floor = lambda c, n: F.floor(c / n).cast("double")
    named = (("largest_cluster_size", F.col("x").cast("double")), ("cluster_count", F.col("c").cast("double")), ("wallet_count", floor(total, 40)),
             ("propagated_label_count", (total % 7).cast("double")), ("conflict_count", (total % 3).cast("double")), ("seed_seen_count", floor(F.col("c"), 10)),
             ("seed_cluster_overlap_count", floor(total, 12)))
    rows = wide.select("m", F.explode(F.array(*[F.struct(F.lit(n).alias("metric_name"), v.alias("value")) for n, v in named])).alias("x")).select("m", "x.*")
    now = rows.select(F.lit("g").alias("metric_group"), "metric_name", F.col("m").cast("string").alias("scope_key"), "value", "m")
    before = now.withColumn("scope_key", (F.col("m") + 1).cast("string")).drop("m")
    return E.compare_drift(now.drop("m"), before).withColumn("m", F.col("scope_key").cast("long")).withColumn("scope_key", F.lit("all"))


@query(f"WITH {MONTHS} SELECT * FROM cmp")
def drift_comparison(spark, sf_dir):
    return monthly(spark, sf_dir)


def _alert_sql() -> str:
    rules = (
        ("largest_cluster_size", "relative_change >= 1.0", "CASE WHEN relative_change >= 2.0 THEN 'critical' ELSE 'warning' END", "relative_increase", 1.0, "Largest cluster size increased beyond the configured guardrail."),
        ("cluster_count", "relative_change <= -0.5 AND (SELECT relative_change IS NULL OR abs(relative_change) <= 0.1 FROM cmp w WHERE w.m = cmp.m AND w.metric_name = 'wallet_count')", "'warning'",
         "relative_drop", 0.5, "Cluster count dropped sharply while wallet count remained similar."),
        ("propagated_label_count", "(relative_change >= 1.0 OR (previous_value = 0 AND value > 0))", "'warning'", "relative_increase", 1.0, "Propagated label count increased beyond the configured guardrail."),
        ("conflict_count", "value >= 1 AND value > previous_value", "'warning'", "absolute_count", 1.0, "Label conflicts increased to a non-trivial count."),
        *[(n, "relative_change <= -0.2", "'warning'", "relative_drop", 0.2, f"{n} dropped beyond the configured guardrail.") for n in ("seed_seen_count", "seed_cluster_overlap_count")])
    return " UNION ALL ".join(
        f"SELECT m, metric_name, scope_key, {sev} AS severity, value AS current_value, previous_value, '{kind}' AS threshold_type, {t}::DOUBLE AS threshold_value, '{msg}' AS message FROM cmp WHERE metric_name = '{n}' AND {when}"
        for n, when, sev, kind, t, msg in rules)


@query(f"WITH {MONTHS} {_alert_sql()}")
def drift_alerts(spark, sf_dir):
    return E.drift_alerts(monthly(spark, sf_dir), by=["m"])


# Served reads ------------------------------------------------------------------------------------


@query(with_(f""", r AS (SELECT cluster_id, max(cluster_size) AS cluster_size, min({f32('confidence')}) AS confidence, 'shared_funder_v1' AS heuristic_version FROM clus GROUP BY 1)
  SELECT * FROM r WHERE cluster_size >= 3 ORDER BY cluster_size DESC, cluster_id LIMIT 50 OFFSET 5""", "clus"))
def api_clusters(spark, sf_dir):
    return api.ranked_clusters(Star(spark, sf_dir).stored, 3, 50, 5)


@query(with_(f"SELECT cluster_id, max(cluster_size) AS cluster_size, min({f32('confidence')}) AS confidence, 'shared_funder_v1' AS heuristic_version FROM clus GROUP BY 1", "clus"))
def api_cluster(spark, sf_dir):
    return api.cluster_rows(Star(spark, sf_dir).stored)


@query(with_(f""", top AS (SELECT cluster_id FROM clus GROUP BY 1 ORDER BY max(cluster_size) DESC, cluster_id LIMIT 1), w AS (SELECT wallet_address FROM clus WHERE cluster_id IN (SELECT cluster_id FROM top))
  SELECT {PAIR_COLUMNS} FROM pair WHERE wallet_a IN (SELECT wallet_address FROM w) AND wallet_b IN (SELECT wallet_address FROM w) ORDER BY wallet_a, wallet_b LIMIT 500""", "clus"))
def api_cluster_edges(spark, sf_dir):
    star = Star(spark, sf_dir)
    own = star.stored
    first = api.ranked_clusters(own, None, 1, 0).select("cluster_id")
    return api.paged(api.inside_cluster(star.pairs, own.join(F.broadcast(first), "cluster_id", "left_semi")), 500, 0, "wallet_a", "wallet_b")  # one row


@query(with_("""SELECT chain_id, entity_id, entity_name AS display_name, entity_category, 'direct_seed' AS created_from, CAST(NULL AS VARCHAR) AS cluster_id FROM named WHERE rn = 1 AND entity_category = 'dex'
  UNION ALL SELECT CAST(1 AS BIGINT), cid.entity_id, sel.entity_name, sel.entity_category, 'cluster_membership', cid.cluster_id FROM cid JOIN sel ON sel.cluster_id = cid.cluster_id WHERE sel.entity_category = 'dex'
  ORDER BY entity_id LIMIT 50""", "named", "sel", "cid"))
def api_entities(spark, sf_dir):
    return api.paged(entities(spark, sf_dir).where("entity_category = 'dex'"), 50, 0, "entity_id")


@query(f"""WITH {MONTHS}, a AS ({_alert_sql()}) SELECT *, m || metric_name AS alert_id FROM a
  ORDER BY CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END DESC, metric_name, scope_key, alert_id LIMIT 50""")
def api_drift_alerts(spark, sf_dir):
    return api.ranked_alerts(drift_alerts(spark, sf_dir).withColumn("alert_id", F.concat("m", "metric_name")), None, 50)


@query(with_("""SELECT label_dimension, label_value, subject_id, confidence, assignment_method, 1 + 2 * CAST(assignment_method = 'cluster_propagation' AS INT) AS n_evidence FROM asg WHERE subject_type = 'address'""", "asg"))
def api_wallet_labels(spark, sf_dir):
    star = Star(spark, sf_dir)
    s, m = star.seeds, star.stored
    labels = star.assignments.where("subject_type = 'address'").select("subject_id", "label_dimension", "label_value", "confidence", "assignment_method")
    found = L.label_evidence(s, m).where("subject_type = 'address'").groupBy("subject_id", "label_dimension", "label_value").agg(F.collect_list("evidence_type").alias("e"))
    return labels.join(found, ["subject_id", "label_dimension", "label_value"], "left").select(
        "label_dimension", "label_value", "subject_id", "confidence", "assignment_method", F.size("e").alias("n_evidence"))


