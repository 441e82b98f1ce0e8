"""Joins and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weftline.operators import joins, sets
from weftline.plans.registry import query
from weftline.session import scratch
from weftline.sources.readers import local_rows
from weftline.sources.writers import bucket_count, write_bucketed


def order_customer(t):
    return F.col("o_custkey") == F.col("c_custkey")


@query(
    "join_inner",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def join_inner(t):
    o, c = t.orders.alias("o"), t.customer.alias("c")
    joined = o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
    return joined.select("o.o_orderkey", "o.o_totalprice", "c.c_name", "c.c_mktsegment")


@query("join_using", "SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)")
def join_using(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id")


@query(
    "join_broadcast",
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def join_broadcast(t):
    nations = t.nation.select("n_nationkey", "n_name")
    joined = joins.broadcast_join(t.customer, nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "c_name", "n_name")


_LINE_ORDER = """SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey"""


@query("join_sort_merge", _LINE_ORDER)
def join_sort_merge(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    joined = joins.merge_join(lines, orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.drop("o_orderkey")


@query(
    "join_shuffle_hash",
    """SELECT l_orderkey, l_linenumber, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def join_shuffle_hash(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    joined = joins.hash_join(lines, parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_linenumber", "p_name", "p_brand")


_BUCKETED = """SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM orders
    JOIN customer ON o_custkey = c_custkey"""


def bucketed_pair(t):
    """Orders and customers as tables with equal bucket counts; hot customers spread by salt."""
    orders, customers = joins.salt_pair(
        t.orders.select("o_orderkey", "o_totalprice", "o_custkey"),
        t.customer.select("c_custkey", "c_name"),
        "o_custkey",
        "c_custkey",
        ["o_orderkey"],
        joins.hot_keys(t.orders, "o_custkey", 0.01),
    )
    buckets = bucket_count(t.orders.count())
    mark = uuid.uuid4().hex[:12]
    left = write_bucketed(
        orders, f"orders_{mark}", scratch(t.spark, "bucketed"), buckets, ["o_custkey", "salt"]
    )
    right = write_bucketed(
        customers, f"customer_{mark}", scratch(t.spark, "bucketed"), buckets, ["c_custkey", "salt"]
    )
    return t.spark.table(left), t.spark.table(right)


@query("join_bucketed", _BUCKETED)
def join_bucketed(t):
    orders, customers = bucketed_pair(t)
    condition = (orders.o_custkey == customers.c_custkey) & (orders.salt == customers.salt)
    joined = joins.merge_join(orders, customers, condition)
    return joined.select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


@query("join_salted", _BUCKETED)
def join_salted(t):
    # A low limit, so that evenly spread tables also have a few keys above it.
    hot = joins.hot_keys(t.orders, "o_custkey", 0.001)
    return joins.salted_join(
        t.orders.select("o_orderkey", "o_totalprice", "o_custkey"),
        t.customer.select("c_custkey", "c_name"),
        "o_custkey",
        "c_custkey",
        ["o_orderkey"],
        hot,
        salts=8,
    ).select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


PRICE_BANDS = [("low", 900.0, 925.0), ("middle", 925.0, 975.0), ("high", 975.0, 1000.0), ("offer", 910.0, 930.0)]


@query(
    "join_theta",
    """SELECT p_partkey, p_retailprice, band FROM part
    JOIN (VALUES ('low', 900, 925), ('middle', 925, 975), ('high', 975, 1000), ('offer', 910, 930)) b(band, lo, hi)
    ON p_retailprice >= lo AND p_retailprice < hi""",
)
def join_theta(t):
    bands = local_rows(t.spark, PRICE_BANDS, "band STRING, lo DOUBLE, hi DOUBLE")
    parts = t.part.select("p_partkey", "p_retailprice")
    joined = joins.range_join(parts, bands, "p_retailprice", "lo", "hi", width=10.0)
    return joined.select("p_partkey", "p_retailprice", "band")


def building(t):
    return t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


def urgent(t):
    return t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey")


_URGENT = "(SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') o"
_BUILDING = "(SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING') c"
_OUTER = "SELECT o_orderkey, o_custkey, c_name FROM {left} {how} JOIN {right} ON o_custkey = c_custkey"


@query("join_left", _OUTER.format(left=_URGENT, how="LEFT", right=_BUILDING))
def join_left(t):
    joined = urgent(t).join(building(t), order_customer(t), "left")
    return joined.select("o_orderkey", "o_custkey", "c_name")


@query("join_right", _OUTER.format(left=_BUILDING, how="RIGHT", right=_URGENT))
def join_right(t):
    joined = building(t).join(urgent(t), order_customer(t), "right")
    return joined.select("o_orderkey", "o_custkey", "c_name")


@query(
    "join_full",
    f"SELECT o_orderkey, o_custkey, c_custkey, c_name FROM {_URGENT} FULL JOIN {_BUILDING} ON o_custkey = c_custkey",
)
def join_full(t):
    return joins.full_join(urgent(t), building(t), "o_custkey", "c_custkey")


@query(
    "join_semi",
    """SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def join_semi(t):
    return joins.semi_join(t.customer.select("c_custkey", "c_name"), urgent(t), "c_custkey", "o_custkey")


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def join_anti(t):
    return joins.anti_join(t.customer.select("c_custkey", "c_name"), urgent(t), "c_custkey", "o_custkey")


@query(
    "join_with",
    """SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_acctbal FROM orders
    JOIN customer ON o_custkey = c_custkey""",
)
def join_with(t):
    pairs = joins.pair_join(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        t.customer.select("c_custkey", "c_name", "c_acctbal"),
        order_customer(t),
        ("placed", "buyer"),
    )
    return pairs.select("placed.*", "buyer.*")


def views_and_clicks(t):
    """The view and click events of each user, as the two sides of an interval join."""
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    views = events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), F.col("ts").alias("view_time")
    )
    clicks = events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), F.col("ts").alias("click_time")
    )
    return views, clicks


INTERVAL_SECONDS = 6 * 3600
INTERVAL_SQL = """SELECT v.event_id AS view_id, v.user_id AS viewer, c.event_id AS click_id
    FROM (SELECT * FROM events WHERE event_type = 'view') v {how}
    JOIN (SELECT * FROM events WHERE event_type = 'click') c
    ON v.user_id = c.user_id AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOURS"""


@query("interval_join_batch", INTERVAL_SQL.format(how=""))
def interval_join_batch(t):
    views, clicks = views_and_clicks(t)
    joined = joins.interval_join(
        views, clicks, "viewer", "clicker", "view_time", "click_time", INTERVAL_SECONDS
    )
    return joined.select("view_id", "viewer", "click_id")


# ---- sets ----


@query(
    "union_all",
    """SELECT o_orderkey, o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""",
)
def union_all(t):
    df = t.orders.select("o_orderkey", "o_orderstatus")
    return sets.union_all([df, df.filter(F.col("o_orderstatus") == "F")])


# The six labelled slices, whose inclusive edges overlap.
_SLICES = [
    ("Very Long Delays", "delay > 360"),
    ("Long Delays", "delay BETWEEN 120 AND 360"),
    ("Short Delays", "delay BETWEEN 60 AND 120"),
    ("Tolerable Delays", "delay BETWEEN 0 AND 60"),
    ("No Delays", "delay = 0"),
    ("Early", "delay < 0"),
]


@query(
    "union_slices",
    " UNION ALL ".join(
        f"""SELECT event_id, delay, '{label}' AS delay_class
        FROM (SELECT event_id, CAST(floor(value) AS BIGINT) - 10 AS delay FROM events) WHERE {condition}"""
        for label, condition in _SLICES
    ),
)
def union_slices(t):
    slices = [(label, F.expr(condition)) for label, condition in _SLICES]
    delays = t.events.select("event_id", (F.floor("value") - 10).alias("delay"))
    return sets.labelled_slices(delays, slices, "delay_class")


@query(
    "table_diff",
    """WITH a AS (SELECT o_orderkey, o_totalprice FROM orders),
    b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
    SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT *, 'right' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def table_diff(t):
    price = F.col("o_totalprice")
    raised = F.when(F.col("o_orderstatus") == "P", price + 1).otherwise(price)
    before = t.orders.select("o_orderkey", "o_totalprice")
    after = t.orders.select("o_orderkey", raised.alias("o_totalprice"))
    return sets.table_difference(before, after)
