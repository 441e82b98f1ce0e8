"""Aggregations, ranking windows, sorting and user-defined aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.columns import hash_split, words
from weftline.functions.udaf import Aggregator, aggregate
from weftline.operators import aggregates as A
from weftline.operators import quantiles as Q
from weftline.operators import ranking as R
from weftline.operators.sessions import sessions
from weftline.plans.registry import query
from weftline.session import spread

# ---- aggregations ----


@query(
    "agg_max_avg",
    """SELECT o_orderpriority, max(o_totalprice) AS max_price, round(avg(o_totalprice), 6) AS avg_price
    FROM orders GROUP BY o_orderpriority""",
)
def agg_max_avg(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.max("o_totalprice").alias("max_price"), F.round(F.avg("o_totalprice"), 6).alias("avg_price")
    )


@query(
    "agg_count_col",
    """SELECT l_returnflag, l_linestatus, count(l_quantity) AS total FROM lineitem
    WHERE l_shipdate <= TIMESTAMP '2000-12-31' GROUP BY ALL ORDER BY total DESC, l_returnflag, l_linestatus""",
)
def agg_count_col(t):
    shipped = t.lineitem.filter(F.col("l_shipdate") <= F.lit("2000-12-31").cast("timestamp_ntz"))
    counts = shipped.groupBy("l_returnflag", "l_linestatus").agg(F.count("l_quantity").alias("total"))
    return counts.orderBy(F.col("total").desc(), "l_returnflag", "l_linestatus")


@query("agg_count_star", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def agg_count_star(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query(
    "agg_common_types",
    "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count DESC, event_type",
)
def agg_common_types(t):
    known = t.events.filter(F.col("event_type").isNotNull())
    return known.groupBy("event_type").count().orderBy(F.col("count").desc(), "event_type")


@query(
    "agg_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag",
)
def agg_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query(
    "agg_approx_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS near FROM lineitem GROUP BY l_returnflag",
)
def agg_approx_distinct(t):
    """The exact count, and whether the estimate is within four of its standard deviations (0.02)."""
    counts = t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.approx_count_distinct("l_partkey", 0.02).alias("estimate")
    )
    near = F.abs(F.col("estimate") - F.col("parts")) <= 0.08 * F.col("parts")
    return counts.select("l_returnflag", "parts", near.alias("near"))


@query(
    "agg_global",
    """SELECT round(sum(l_quantity), 2) AS total, round(avg(l_extendedprice), 6) AS average,
        min(l_extendedprice) AS smallest, max(l_extendedprice) AS largest FROM lineitem""",
)
def agg_global(t):
    return t.lineitem.agg(
        F.round(F.sum("l_quantity"), 2).alias("total"),
        F.round(F.avg("l_extendedprice"), 6).alias("average"),
        F.min("l_extendedprice").alias("smallest"),
        F.max("l_extendedprice").alias("largest"),
    )


@query(
    "minmax_all",
    """SELECT min(p_size) AS min_p_size, max(p_size) AS max_p_size, min(p_retailprice) AS min_p_retailprice,
        max(p_retailprice) AS max_p_retailprice FROM part""",
)
def minmax_all(t):
    return A.min_max(t.part, ["p_size", "p_retailprice"])


@query(
    "agg_reduce_filtered",
    """SELECT CAST(sum(quality) AS BIGINT) AS sum_quality, CAST(sum(n_chars) AS BIGINT) AS sum_chars, min(n_chars) AS min_chars,
        max(n_chars) AS max_chars, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE quality IS NOT NULL AND n_chars IS NOT NULL""",
)
def agg_reduce_filtered(t):
    both = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    both = both.filter(F.col("quality").isNotNull() & F.col("n_chars").isNotNull())
    return both.agg(
        F.sum("quality").alias("sum_quality"),
        F.sum("n_chars").alias("sum_chars"),
        F.min("n_chars").alias("min_chars"),
        F.max("n_chars").alias("max_chars"),
        F.count("*").alias("n"),
    )


_MULTI_AVG = """SELECT n_name, round(avg(c_acctbal), 6) AS avg_balance, round(avg(c_custkey), 6) AS avg_key,
        count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
    ORDER BY avg_balance DESC, avg_key DESC, n_name"""


@query("agg_multi_avg", _MULTI_AVG)
def agg_multi_avg(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    means = joined.groupBy("n_name").agg(
        F.round(F.avg("c_acctbal"), 6).alias("avg_balance"),
        F.round(F.avg("c_custkey"), 6).alias("avg_key"),
        F.count("*").alias("n"),
    )
    return means.orderBy(F.col("avg_balance").desc(), F.col("avg_key").desc(), "n_name")


@query(
    "agg_mixed",
    """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean, round(sum(c_acctbal), 2) AS total,
        arg_min(c_name, c_custkey) AS first_name, round(stddev_samp(c_acctbal), 6) AS deviation,
        (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT DISTINCT CAST(i.c_nationkey AS VARCHAR) AS k FROM customer i
            WHERE i.c_mktsegment = customer.c_mktsegment)) AS nations
    FROM customer GROUP BY c_mktsegment""",
)
def agg_mixed(t):
    # The set of nations has a fixed bound; an open-ended set would be grouped, not collected.
    nations = F.array_sort(F.collect_set(F.col("c_nationkey").cast("string")))
    return t.customer.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"),
        F.round(F.mean("c_acctbal"), 6).alias("mean"),
        F.round(F.sum("c_acctbal"), 2).alias("total"),
        F.min_by("c_name", "c_custkey").alias("first_name"),
        F.round(F.stddev_samp("c_acctbal"), 6).alias("deviation"),
        F.array_join(nations, ",").alias("nations"),
    )


@query(
    "agg_pivot",
    "SELECT o_orderpriority, "
    + ", ".join(
        f"round(avg(o_totalprice) FILTER (month(o_orderdate) = {m}), 2) AS {name}_AvgPrice, "
        f"max(o_totalprice) FILTER (month(o_orderdate) = {m}) AS {name}_MaxPrice"
        for m, name in [(1, "JAN"), (2, "FEB"), (3, "MAR")]
    )
    + " FROM orders GROUP BY o_orderpriority ORDER BY o_orderpriority",
)
def agg_pivot(t):
    monthly = t.orders.withColumn("month", F.month("o_orderdate"))
    measures = {"AvgPrice": F.round(F.avg("o_totalprice"), 2), "MaxPrice": F.max("o_totalprice")}
    names = {1: "JAN", 2: "FEB", 3: "MAR"}
    return A.pivot_named(monthly, ["o_orderpriority"], "month", names, measures).orderBy("o_orderpriority")


@query(
    "freq_items",
    """SELECT string_agg(event_type, ',' ORDER BY event_type) AS types FROM
    (SELECT event_type FROM events GROUP BY event_type HAVING count(*) >= 0.1 * (SELECT count(*) FROM events))""",
)
def freq_items(t):
    """The candidates may include rarer items, so they are counted; there are at most ten or so."""
    found = t.events.stat.freqItems(["event_type"], 0.1)
    candidates = found.select(F.explode("event_type_freqItems").alias("event_type"))
    counted = t.events.join(F.broadcast(candidates), "event_type").groupBy("event_type").count()
    least = t.events.agg((0.1 * F.count(F.lit(1))).alias("n")).scalar()
    frequent = counted.filter(F.col("count") >= least)
    return frequent.agg(F.array_join(F.array_sort(F.collect_list("event_type")), ",").alias("types"))


@query(
    "top_n_array",
    """SELECT string_agg(event_type, ',' ORDER BY n DESC, event_type) AS top_types FROM
    (SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 3)""",
)
def top_n_array(t):
    top = A.top_n_array(t.events, "event_type", 3, "top_types")
    return top.select(F.array_join("top_types", ",").alias("top_types"))


@query(
    "summary_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS q25,
        CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS q50, CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_linenumber")
    ),
)
def summary_stats(t):
    out = A.summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_linenumber"])
    return out.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@query(
    "quantile_exact_rank",
    """SELECT o_orderpriority, quantile_disc(o_totalprice, 0.25) AS q25, quantile_disc(o_totalprice, 0.75) AS q75
    FROM orders GROUP BY o_orderpriority""",
)
def quantile_exact_rank(t):
    wanted = {"q25": 0.25, "q75": 0.75}
    return Q.quantiles(t.orders, "o_totalprice", wanted, ["o_orderpriority"], interpolate=False)


@query(
    "quantile_approx",
    "SELECT o_orderpriority, count(*) AS n, true AS q25, true AS q75 FROM orders GROUP BY o_orderpriority",
)
def quantile_approx(t):
    """Whether the place of each estimate is in the range of the sketch: floor((p - e) n) to ceil((p + e) n), e = 0.001."""
    wanted = {"q25": 0.25, "q75": 0.75}
    found = A.approximate_quantiles(t.orders, "o_totalprice", wanted, ["o_orderpriority"])
    placed = t.orders.select("o_orderpriority", "o_totalprice").join(F.broadcast(found), "o_orderpriority")

    def near(name, p):
        n = F.count(F.lit(1))
        below = F.count_if(F.col("o_totalprice") < F.col(name))
        up_to = F.count_if(F.col("o_totalprice") <= F.col(name))
        return ((below < F.ceil((p + 0.001) * n)) & (up_to >= F.floor((p - 0.001) * n))).alias(name)

    return placed.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), *[near(name, p) for name, p in wanted.items()]
    )


@query(
    "quantile_interp",
    """SELECT round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90
    FROM lineitem""",
)
def quantile_interp(t):
    found = Q.quantiles(t.lineitem, "l_extendedprice", {"p75": 0.75, "p90": 0.9})
    return found.select(F.round("p75", 4).alias("p75"), F.round("p90", 4).alias("p90"))


def _by_part(t, part, name):
    counted = t.orders.groupBy(part.alias(name)).agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), name)


_BY_PART = "SELECT CAST({0}(o_orderdate) AS INTEGER) AS {0}, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1"


@query("by_month", _BY_PART.format("month"))
def by_month(t):
    return _by_part(t, F.month("o_orderdate"), "month")


@query("by_week", _BY_PART.format("week"))
def by_week(t):
    return _by_part(t, F.weekofyear("o_orderdate"), "week")


@query("by_year", _BY_PART.format("year"))
def by_year(t):
    return _by_part(t, F.year("o_orderdate"), "year")


@query(
    "pair_counts",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL ORDER BY n DESC, 1, 2",
)
def pair_counts(t):
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "o_orderstatus", "o_orderpriority")


@query(
    "chi_square_pairs",
    """WITH p AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY ALL),
    e AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS expected FROM p)
    SELECT CAST((SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM p) AS INTEGER) AS degrees_of_freedom,
        round(sum((n - expected) * (n - expected) / expected), 4) AS statistic FROM e""",
)
def chi_square_pairs(t):
    test = A.chi_square(t.orders, "o_orderstatus", "o_orderpriority")
    return test.select(
        F.col("degrees_of_freedom").cast("int").alias("degrees_of_freedom"),
        F.round("statistic", 4).alias("statistic"),
    )


# ---- ranking windows ----

_PRICED = "SELECT o_orderkey, o_orderpriority, o_totalprice, {0} FROM orders"


def priced_orders(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    "win_rank",
    _PRICED.format(
        "CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS INTEGER) AS price_rank"
    ),
)
def win_rank(t):
    return R.with_ranks(priced_orders(t), ["o_orderpriority"], "o_totalprice", True, rank="price_rank")


@query(
    "win_dense_rank",
    """SELECT l_returnflag, l_quantity, l_orderkey,
        CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS INTEGER) AS quantity_rank FROM lineitem""",
)
def win_dense_rank(t):
    lines = t.lineitem.select("l_returnflag", "l_quantity", "l_orderkey")
    return R.with_ranks(lines, ["l_returnflag"], "l_quantity", True, dense_rank="quantity_rank")


@query(
    "win_row_number",
    """SELECT event_id, event_type, value,
        CAST(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INTEGER) AS place FROM events""",
)
def win_row_number(t):
    events = t.events.select("event_id", "event_type", "value")
    return R.with_ranks(events, ["event_type"], "value", True, row_number="place", tie_break="event_id")


@query(
    "win_running_count",
    """SELECT l_returnflag, l_shipdate, l_orderkey,
        count(*) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS so_far FROM lineitem""",
)
def win_running_count(t):
    lines = t.lineitem.select("l_returnflag", "l_shipdate", "l_orderkey")
    return R.with_ranks(lines, ["l_returnflag"], "l_shipdate", running_count="so_far")


@query(
    "top3_per_group",
    """SELECT * FROM (SELECT c_nationkey, c_custkey, c_acctbal,
        CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS INTEGER) AS rank FROM customer)
    WHERE rank <= 3""",
)
def top3_per_group(t):
    return R.top_values(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "c_acctbal", 3)


@query(
    "session_batch",
    """WITH e AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events),
    s AS (SELECT *, sum(CASE WHEN ts - previous > INTERVAL 6 HOURS THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM e)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOURS AS session_end, count(*) AS n,
        round(sum(value), 2) AS total FROM s GROUP BY user_id, session""",
)
def session_batch(t):
    found = sessions(t.events, "user_id", "ts", 6 * 3600, [("total", F.col("value"))])
    return found.select(
        "user_id",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "n",
        F.round("total", 2).alias("total"),
    )


# ---- sort, limit, distinct, sample ----


@query(
    "sort_multi",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey",
)
def sort_multi(t):
    # The unique last key lets the range shuffle split rows of one status and price.
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return df.orderBy(F.col("o_orderstatus").asc(), F.col("o_totalprice").desc(), "o_orderkey")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return df.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("limit_n", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 1000)")
def limit_n(t):
    return t.orders.limit(1000).agg(F.count("*").alias("n"))


@query("distinct_vals", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_vals(t):
    return t.lineitem.select("l_partkey", "l_suppkey").filter(F.col("l_partkey").isNotNull()).distinct()


@query(
    "hash_split",
    """SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
        THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def hash_split_query(t):
    train, test = hash_split(t.orders.select("o_orderkey"), "o_orderkey", 80)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# ---- user-defined aggregates and table functions ----


@query("udaf_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def udaf_count(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "udaf_sum",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS calls FROM orders GROUP BY 1 ORDER BY calls DESC, 1""",
)
def udaf_sum(t):
    ones = t.orders.select(F.month("o_orderdate").alias("month"), F.lit(1).cast("bigint").alias("call"))
    return ones.groupBy("month").agg(F.sum("call").alias("calls")).orderBy(F.col("calls").desc(), "month")


@query(
    "udaf_avg",
    """SELECT lang, coalesce(round(avg(quality), 6), 0.0) AS avg_quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang""",
)
def udaf_avg(t):
    rated = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    mean = F.try_divide(F.sum("quality"), F.count("quality"))
    return rated.groupBy("lang").agg(F.coalesce(F.round(mean, 6), F.lit(0.0)).alias("avg_quality"))


_FLAG_AVG = """SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_quantity{more} FROM lineitem GROUP BY l_returnflag"""


@query(
    "udaf_multi_avg",
    _FLAG_AVG.format(
        more=", round(avg(l_extendedprice), 6) AS avg_price, round(avg(l_discount), 6) AS avg_discount, count(*) AS n"
    ),
)
def udaf_multi_avg(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.avg("l_quantity"), 6).alias("avg_quantity"),
        F.round(F.avg("l_extendedprice"), 6).alias("avg_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.count("*").alias("n"),
    )


class Mean(Aggregator):
    """The mean of one column with a (sum, count) buffer; 0.0 of no rows."""

    output_type = T.DoubleType()

    def __init__(self, column: str):
        self.column = column

    def zero(self):
        return 0.0, 0

    def reduce(self, buffer, rows):
        values = rows[self.column].dropna()
        return buffer[0] + float(values.sum()), buffer[1] + len(values)

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def finish(self, buffer):
        return buffer[0] / buffer[1] if buffer[1] else 0.0


@query("udaf_generic", _FLAG_AVG.format(more=""))
def udaf_generic(t):
    lines = spread(t.lineitem.select("l_returnflag", "l_quantity"))
    means = aggregate(lines, ["l_returnflag"], ["l_quantity"], Mean("l_quantity"), "avg_quantity")
    return means.withColumn("avg_quantity", F.round("avg_quantity", 6))


@query(
    "map_groups",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1 ORDER BY 1""",
)
def map_groups(t):
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("year"))
    return yearly.agg(F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy("year")


@query(
    "udtf_words",
    """SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct, max(length(word)) AS longest FROM
    (SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents) GROUP BY doc_id""",
)
def udtf_words(t):
    # Counted per (document, word) first, so a long document is not gathered word by word.
    texts = spread(t.documents.select("doc_id", "text"))
    split = texts.select("doc_id", F.explode(words(F.col("text"))).alias("word"))
    per_word = split.groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    return per_word.groupBy("doc_id").agg(
        F.sum("n").alias("n_words"),
        F.count("*").alias("n_distinct"),
        F.max(F.length("word")).cast("bigint").alias("longest"),
    )
