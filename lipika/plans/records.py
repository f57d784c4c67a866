"""Queries over orders, lines, parts, events: the record-level operators, and generic relational coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lipika.operators import checkpoints as C
from lipika.operators import geometry as G
from lipika.operators import ordering as O
from lipika.operators import pairs as P
from lipika.plans.registry import Tables, query
from lipika.sources import readers as R
from lipika.streaming import logs as S

REASONS = ("low", "blank", "unencodable", "ctc")


def _geometry(t: Tables) -> DataFrame:
    """Lines of orders as samples: width from the quantity, height from the part's size, its name as text."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("h"), F.col("p_name").alias("gt"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_discount").alias("ink"), (F.col("l_quantity") * 6).alias("w")).join(part, "l_partkey")
    guards = [(F.col("h") < 16, "low"), (F.col("ink") < 0.001, "blank"), (F.col("gt").rlike("[xz]"), "unencodable"), (~P.ctc_feasible(F.col("w"), F.col("h"), F.length("gt")), "ctc")]
    return rows.withColumn("reason", P.first_reason(guards))


_GEOMETRY = """g AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity * 6 AS w, p_size AS h, p_name AS gt, CASE WHEN p_size < 16 THEN 'low' WHEN l_discount < 0.001 THEN 'blank' WHEN regexp_matches(p_name, '[xz]') THEN 'unencodable'
  WHEN (CASE WHEN p_size > 0 THEN floor(l_quantity * 6 * (48.0::DOUBLE / p_size)) ELSE 0 END) < length(p_name) THEN 'ctc' END AS reason FROM lineitem JOIN part ON p_partkey = l_partkey)"""


@query(f"WITH {_GEOMETRY} SELECT l_orderkey, l_linenumber, w, h, reason FROM g")
def guard_cascade(t: Tables) -> DataFrame:
    return _geometry(t).select("l_orderkey", "l_linenumber", "w", "h", "reason")


@query(f"WITH {_GEOMETRY} SELECT count(*) AS n_rows, " + ", ".join(f"count(*) FILTER (reason = '{r}') AS n_{r}" for r in REASONS) + ", count(*) FILTER (reason IS NULL) AS n_usable, round(count(*) FILTER (reason IS NULL) * 100 / count(*), 1) AS usable_percent FROM g")
def guard_tally(t: Tables) -> DataFrame:
    return P.guard_tally(_geometry(t), "reason", REASONS)


@query(f"WITH {_GEOMETRY} SELECT l_returnflag, count(*) AS n, count(reason) AS skipped, CASE WHEN count(*) = 0 THEN 'empty' WHEN count(reason) / count(*) > 0.05 THEN 'warn' ELSE 'ok' END AS gate FROM g GROUP BY l_returnflag")
def skip_gate(t: Tables) -> DataFrame:
    rows = _geometry(t).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("reason").alias("skipped"))
    return rows.withColumn("gate", P.skip_gate(F.col("skipped"), F.col("n")))


@query("SELECT l_orderkey, l_linenumber, x, y, least(ceil(l_quantity + l_quantity * 4) + 4, 200) - x AS w, least(ceil(l_tax * 100 + l_quantity) + 4, 60) - y AS h FROM (SELECT *, greatest(floor(l_quantity) - 4, 0) AS x, greatest(floor(l_tax * 100) - 4, 0) AS y FROM lineitem)")
def crop_boxes(t: Tables) -> DataFrame:
    box = P.crop_box(F.col("l_quantity"), F.col("l_tax") * 100, F.col("l_quantity") * 4, F.col("l_quantity"), F.lit(200), F.lit(60), 4)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", box.alias("b"))
    return rows.select("l_orderkey", "l_linenumber", *[F.col(f"b.{k}").cast("double").alias(k) for k in ("x", "y", "w", "h")])


@query("SELECT n_nationkey, p_partkey, p_name FROM nation, (SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 20)")
def style_cross_cap(t: Tables) -> DataFrame:
    """Every nation with the first 20 parts: a cross product whose right side is capped."""
    return P.cross_cap(t.nation.select("n_nationkey"), t.part.select("p_partkey", "p_name"), "p_partkey", 20)


KINDS = ["click", "view", "purchase", "signup", "refund", "none"]


@query("SELECT k AS kind, count(event_id) AS n FROM (SELECT unnest([" + ", ".join(f"'{k}'" for k in KINDS) + "]) AS k) LEFT JOIN events ON CASE WHEN event_type IN (" + ", ".join(f"'{k}'" for k in KINDS) + ") THEN event_type ELSE 'none' END = k GROUP BY k")
def kind_histogram_zero_filled(t: Tables) -> DataFrame:
    """Counts of fixed kinds, zero where there are none, what is unknown under one kind."""
    kind = F.when(F.col("event_type").isin(KINDS), F.col("event_type")).otherwise("none")
    counts = t.events.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return P.with_default(t.spark.createDataFrame([(k,) for k in KINDS], "kind string"), counts, "kind", "n", 0)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def kind_counts(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "event_type")


@query("SELECT event_type AS category, CAST(round(avg(CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END) * 100) AS INTEGER) AS percent, count(*) AS n FROM events GROUP BY event_type")
def json_map_category(t: Tables) -> DataFrame:
    """Shares of each category out of JSON properties."""
    rows = t.events.select(F.col("event_type").alias("category"), F.from_json("props", "map<string,bigint>").alias("p"))
    return R.category_accuracy(rows.select("category", (F.col("p")["k"] % 2 == 0).alias("ok")))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_per_user(t: Tables) -> DataFrame:
    return O.last_per_key(t.events, "user_id", "event_type", "event_id")


_NEAR = "r.v >= s.low - 10 AND r.v <= s.high + 10"


@query(
    f"""WITH RECURSIVE r AS (SELECT user_id, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
s AS (SELECT user_id, k, CAST(0 AS BIGINT) AS island, v AS low, v AS high FROM r WHERE k = 1 UNION ALL
  SELECT r.user_id, r.k, CASE WHEN {_NEAR} THEN s.island ELSE s.island + 1 END, CASE WHEN {_NEAR} THEN least(s.low, r.v) ELSE r.v END, CASE WHEN {_NEAR} THEN greatest(s.high, r.v) ELSE r.v END FROM s JOIN r ON r.user_id = s.user_id AND r.k = s.k + 1)
SELECT user_id, island, count(*) AS n, min(low) AS low, max(high) AS high FROM s GROUP BY user_id, island"""
)
def island_lines(t: Tables) -> DataFrame:
    """Runs of a user's events whose value stays near the extent of the run so far."""
    return G.islands(t.events, "user_id", ["ts", "event_id"], "value", 10.0)


@query("WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders) SELECT o_orderkey, o_totalprice FROM r WHERE n <= 25 OR r IN (SELECT i * (n - 1) // 24 FROM range(25) x(i))")
def even_picks(t: Tables) -> DataFrame:
    return O.even_picks(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 25)


def _runs(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("iter"), F.col("o_totalprice").alias("bcer"), F.concat(F.lit("ckpt_"), F.col("o_orderkey").cast("string")).alias("file"))


@query("SELECT 'ckpt_' || o_orderkey AS file, o_totalprice AS bcer FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1")
def best_checkpoint(t: Tables) -> DataFrame:
    return C.best(_runs(t), "bcer", "iter", "file")


@query("SELECT 'ckpt_' || o_orderkey AS file, 'cap' AS tier FROM orders WHERE o_orderkey > 0 AND o_orderkey <= 1000 ORDER BY o_totalprice, o_orderkey LIMIT 1")
def best_capped(t: Tables) -> DataFrame:
    return C.best_capped(_runs(t), "bcer", "iter", "file", 1000, "rolling")


@query("WITH f AS (SELECT * FROM orders WHERE o_orderkey > 700) SELECT 'ckpt_' || o_orderkey AS file, 'widened' AS tier FROM f WHERE o_orderkey <= 1000 ORDER BY o_totalprice, o_orderkey LIMIT 1")
def best_with_fallback(t: Tables) -> DataFrame:
    return C.best_capped(_runs(t).where("iter > 700"), "bcer", "iter", "file", 500, "rolling")


@query(
    """WITH a AS (SELECT o_custkey AS run, o_orderkey AS iter, o_totalprice AS bcer, min(o_totalprice) OVER w AS best_so_far, coalesce(o_totalprice < min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_new_best FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT run, iter, bcer, best_so_far, is_new_best, iter - max(CASE WHEN is_new_best THEN iter END) OVER (PARTITION BY run ORDER BY iter) AS since_best FROM a"""
)
def running_best(t: Tables) -> DataFrame:
    return C.course(_runs(t).drop("file"), ["run"], "bcer", "iter")


@query(
    "SELECT o_custkey AS run, max(o_orderkey) AS last_iteration, min(o_totalprice) AS best_error, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS best_iteration, max(o_orderkey) - arg_min(o_orderkey, (o_totalprice, o_orderkey)) >= 1000 AS on_plateau FROM orders GROUP BY o_custkey"
)
def plateau(t: Tables) -> DataFrame:
    return C.plateau(_runs(t), ["run"], "bcer", "iter", 1000)


@query("SELECT c_custkey, coalesce(CAST(n AS VARCHAR), '?') AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def outcome_or_missing(t: Tables) -> DataFrame:
    """Customers with the number of their orders, or a mark."""
    scores = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return P.outcome_or_missing(t.customer.select("c_custkey"), scores, "c_custkey", "n")


@query("WITH s AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS r FROM (SELECT DISTINCT o_orderstatus AS s FROM orders)) SELECT o_orderstatus, r % 2 AS worker, count(*) AS n FROM orders JOIN s ON s = o_orderstatus GROUP BY ALL")
def worker_shards(t: Tables) -> DataFrame:
    """Orders of one status stay together; statuses go round to two workers."""
    return P.worker_shards(t.orders.select("o_orderstatus"), "o_orderstatus", 2).groupBy("o_orderstatus", F.col("worker").cast("long").alias("worker")).agg(F.count("*").alias("n"))


@query(
    """WITH f AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY c_nationkey), d AS (SELECT n_nationkey AS k, row_number() OVER (ORDER BY n_name) AS pos FROM nation WHERE n_regionkey < 3),
a AS (SELECT k, pos, f.n IS NOT NULL AS present FROM d LEFT JOIN f USING (k)), b AS (SELECT k, (SELECT max(pos) FROM d) + row_number() OVER (ORDER BY k) AS pos, true AS present FROM f WHERE k NOT IN (SELECT k FROM d))
SELECT * FROM a UNION ALL SELECT * FROM b"""
)
def declared_then_extra(t: Tables) -> DataFrame:
    """Declared nations in their order, with whether they have customers, and then the others that have."""
    from pyspark.sql import Window as W

    declared = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("k"), F.row_number().over(W.orderBy("n_name")).cast("long").alias("pos"))
    return P.declared_then_extra(declared, t.customer.select(F.col("c_nationkey").alias("k")), "k")


# streams: every table is drained once, in micro-batches


def _folder(t: Tables) -> str:
    """Where a stream keeps its state and output."""
    import atexit
    import shutil
    import tempfile

    named = t.spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if t.spark.conf.get("spark.master", "").split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    private = tempfile.mkdtemp(prefix="lipika-stream-")
    atexit.register(shutil.rmtree, private, ignore_errors=True)
    return f"file://{private}"


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def stream_counts(t: Tables) -> DataFrame:
    rows = S.drained(S.counts_by(S.event_stream(t.spark, f"{t.folder}/events.parquet"), "event_type"), _folder(t))
    return rows.withColumn("total", F.round("total", 4))


@query("SELECT min(value) AS best, arg_min(event_id, (value, event_id)) AS best_iter, max(event_id) AS last_iter FROM events")
def stream_running_best(t: Tables) -> DataFrame:
    progress = S.event_stream(t.spark, f"{t.folder}/events.parquet").select(F.col("value").alias("bcer"), F.col("event_id").alias("iter"))
    return S.drained(S.running_best(progress), _folder(t))


@query("SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_tumbling(t: Tables) -> DataFrame:
    """Hourly counts of event time under a watermark (an extension)."""
    rows = S.drained(S.tumbling(S.event_stream(t.spark, f"{t.folder}/events.parquet")), _folder(t))
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


# generic relational coverage


@query(
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_discount, count(*) AS n
FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus"""
)
def pricing_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("date"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_discount"), F.count("*").alias("n")
    )


@query(
    """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
)
def revenue_by_nation(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def customers_without_orders(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(t: Tables) -> DataFrame:
    return t.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").select("o_orderkey", "o_totalprice").limit(10)
