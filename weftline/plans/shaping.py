"""Projections, filters and scalar functions."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import columns as C
from weftline.functions.partitions import filter_opaque, map_partitions
from weftline.operators import filters
from weftline.operators.sets import with_scaled_copy
from weftline.plans.registry import query
from weftline.schemas import EVENT_PROPS
from weftline.session import spread

# ---- projections ----


@query("select_cols", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def select_cols(t):
    orders = t.orders
    return orders.select("o_orderkey", F.col("o_orderpriority"), orders.o_totalprice)


@query(
    "project_arith",
    """SELECT l_orderkey, l_linenumber, l_quantity * 2 AS double_quantity,
        round(l_extendedprice * (1 - l_discount), 4) AS revenue FROM lineitem""",
)
def project_arith(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * 2).alias("double_quantity"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"),
    )


@query("big_hitters", "SELECT o_orderkey, o_totalprice, o_totalprice > 250000 AS is_big FROM orders")
def big_hitters(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return df.withColumn("is_big", F.col("o_totalprice") > 250000)


@query("rename_col", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier")
def rename_col(t):
    return t.supplier.withColumnsRenamed({"s_suppkey": "supplier_id", "s_name": "supplier_name"})


@query("drop_col", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def drop_col(t):
    return t.customer.drop("c_mktsegment")


@query(
    "cast_cols",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
        CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem""",
)
def cast_cols(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
    )


@query("cast_by_type", "SELECT * REPLACE (CAST(l_linenumber AS DOUBLE) AS l_linenumber) FROM lineitem")
def cast_by_type(t):
    return C.cast_by_type(t.lineitem, T.IntegerType, "double")


@query("const_col", "SELECT *, 'supplier' AS kind, CAST(1 AS INTEGER) AS one FROM supplier")
def const_col(t):
    return t.supplier.withColumn("kind", F.lit("supplier")).withColumn("one", F.lit(1))


@query(
    "status_two_way",
    """SELECT l_orderkey, l_linenumber, l_quantity,
        CASE WHEN l_quantity <= 10 THEN 'On-time' ELSE 'Delayed' END AS status FROM lineitem""",
)
def status_two_way(t):
    status = C.two_way(F.col("l_quantity") <= 10, "On-time", "Delayed")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", status.alias("status"))


# The delay classes and their edges.
DELAY_EDGES = [
    (-1e-9, "Early"),
    (0, "No Delays"),
    (60, "Tolerable Delays"),
    (120, "Short Delays"),
    (360, "Long Delays"),
]
BEYOND_EDGES = "Very Long Delays"
BUCKET_SQL = """SELECT event_id, delay, CASE WHEN delay > 360 THEN 'Very Long Delays'
        WHEN delay > 120 THEN 'Long Delays' WHEN delay > 60 THEN 'Short Delays'
        WHEN delay > 0 THEN 'Tolerable Delays' WHEN delay = 0 THEN 'No Delays' ELSE 'Early' END AS delay_class
    FROM (SELECT event_id, CAST(floor(value) AS BIGINT) - 10 AS delay FROM events)"""


def delays(t):
    """Events with a whole-number delay that is early, zero or late."""
    return t.events.select("event_id", (F.floor("value").cast("bigint") - 10).alias("delay"))


@query("bucket_case", BUCKET_SQL)
def bucket_case(t):
    return delays(t).withColumn("delay_class", C.bucketize(F.col("delay"), DELAY_EDGES, BEYOND_EDGES))


@query("json_expand", "SELECT event_id, CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_expand(t):
    parsed = t.events.select("event_id", F.from_json("props", EVENT_PROPS).alias("data"))
    return parsed.select("event_id", "data.*")


@query(
    "map_project",
    "SELECT c_custkey AS id, c_name AS name, c_acctbal * 12 AS yearly_balance FROM customer",
)
def map_project(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") * 12).alias("yearly_balance"),
    )


# ---- filters ----


@query("filter_cmp", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_discount < 0.05")
def filter_cmp(t):
    df = t.lineitem.where("l_quantity > 30").filter(F.col("l_discount") < 0.05)
    return df.select("l_orderkey", "l_linenumber", "l_quantity")


_LABELLED = "(SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def labelled_documents(t):
    """Documents with their quality label, NULL where none is given."""
    return t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("filter_ne", f"SELECT doc_id, lang, quality FROM {_LABELLED} WHERE quality <> 0")
def filter_ne(t):
    return labelled_documents(t).filter(F.col("quality") != 0)


@query("filter_ne_nullsafe", f"SELECT doc_id, lang FROM {_LABELLED} WHERE quality IS DISTINCT FROM 0")
def filter_ne_nullsafe(t):
    kept = labelled_documents(t).filter(filters.not_equal_keep_null(F.col("quality"), 0))
    return kept.select("doc_id", "lang")


@query("filter_notnull", f"SELECT doc_id, lang, quality FROM {_LABELLED} WHERE quality IS NOT NULL")
def filter_notnull(t):
    return labelled_documents(t).filter(F.col("quality").isNotNull())


@query(
    "filter_between",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
    AND o_totalprice BETWEEN 10000 AND 200000""",
)
def filter_between(t):
    first, last = datetime.datetime(1996, 1, 1), datetime.datetime(1996, 12, 31)
    low, high = (F.lit(d.isoformat(" ")).cast("timestamp_ntz") for d in (first, last))
    return t.orders.filter(
        F.col("o_orderdate").between(low, high) & F.col("o_totalprice").between(10000, 200000)
    ).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')")
def filter_in(t):
    df = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return df.filter(F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", "o_orderpriority")


@query("filter_prefix", "SELECT p_partkey, p_type, p_name FROM part WHERE p_type LIKE 'S%' AND p_name LIKE '%ring'")
def filter_prefix(t):
    df = t.part.filter(F.col("p_type").startswith("S")).filter(F.expr("p_name LIKE '%ring'"))
    return df.select("p_partkey", "p_type", "p_name")


@query(
    "filter_and",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity >= 20 AND l_tax > 0.02""",
)
def filter_and(t):
    df = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    df = df.filter(F.col("l_quantity") >= 20).filter(F.col("l_tax") > 0.02)
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("filter_udf", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")
def filter_udf(t):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    kept = filter_opaque(
        df, ["o_totalprice", "o_orderstatus"], lambda price, status: (price > 100000) & (status == "O")
    )
    return kept.select("o_orderkey", "o_totalprice")


@query("below_frac_of_max", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < (SELECT max(c_acctbal) * 0.2 FROM customer)")
def below_frac_of_max(t):
    return filters.below_fraction_of_max(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 0.2)


@query("above_p75", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT quantile_cont(o_totalprice, 0.75) FROM orders)")
def above_p75(t):
    return filters.above_quantile(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 0.75)


@query(
    "last_n_days",
    """SELECT event_id, ts, event_type FROM events
    WHERE ts >= (SELECT CAST(CAST(max(ts) AS DATE) - 7 AS TIMESTAMP) FROM events)""",
)
def last_n_days(t):
    return filters.last_days(t.events.select("event_id", "ts", "event_type"), "ts", 7)


@query("dropna_subset", f"SELECT doc_id, lang, quality FROM {_LABELLED} WHERE lang IS NOT NULL AND quality IS NOT NULL")
def dropna_subset(t):
    return labelled_documents(t).dropna(subset=["lang", "quality"])


@query(
    "filter_extremes",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem
    WHERE l_extendedprice > 0 AND l_quantity <= 45 AND l_tax <= 0.07""",
)
def filter_extremes(t):
    sane = (F.col("l_extendedprice") > 0) & (F.col("l_quantity") <= 45) & (F.col("l_tax") <= 0.07)
    return t.lineitem.filter(sane).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


# ---- scalar functions ----


@query(
    "fn_concat",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || o_orderpriority ||
        CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS author_id FROM orders""",
)
def fn_concat(t):
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey", F.concat(F.col("o_orderkey"), F.col("o_orderpriority"), status).alias("author_id")
    )


@query(
    "fn_parse_money",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice, 2) END AS price FROM orders",
)
def fn_parse_money(t):
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    shown = F.when(F.col("o_orderstatus") == "P", F.lit("on request")).otherwise(text)
    return t.orders.select("o_orderkey", C.parse_money(shown).alias("price"))


@query("fn_substr", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def fn_substr(t):
    stamped = t.orders.select("o_orderkey", F.date_format("o_orderdate", "MMddHHmm").alias("date"))
    return stamped.select("o_orderkey", F.substring("date", 1, 2).cast("int").alias("month"))


def sensor_lines(t):
    """Events as ``time#value`` lines; errors have no number after the sign."""
    shown = F.when(F.col("event_type") == "error", "n/a").otherwise(F.floor("value").cast("string"))
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", F.concat(stamp, F.lit("#"), shown).alias("line"))


@query(
    "fn_split_parse",
    """SELECT event_id, date_trunc('second', ts) AS event_time,
        CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INTEGER) END AS reading FROM events""",
)
def fn_split_parse(t):
    line = F.col("line")
    return sensor_lines(t).select(
        "event_id",
        C.split_field(line, "#", 1, "timestamp_ntz").alias("event_time"),
        C.split_field(line, "#", 2, "int").alias("reading"),
    )


@query(
    "word_count",
    """SELECT word, count(*) AS n FROM
    (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents) GROUP BY word""",
)
def word_count(t):
    texts = spread(t.documents.select("text"))
    split = texts.select(F.explode(C.words(F.col("text"))).alias("word"))
    return split.groupBy("word").agg(F.count("*").alias("n"))


@query(
    "number_count",
    r"""SELECT CAST(word AS INTEGER) AS number, count(*) AS n FROM
    (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents)
    WHERE regexp_full_match(word, '[0-9]+') AND TRY_CAST(word AS INTEGER) IS NOT NULL GROUP BY ALL""",
)
def number_count(t):
    return count_numbers(spread(t.documents.select("text")), "text")


def count_numbers(df, column):
    """How often each whole number occurs as a word; other words are passed over."""
    split = df.select(F.explode(C.words(F.col(column))).alias("word"))
    number = F.when(F.col("word").rlike(r"\A[0-9]+\z"), F.col("word").try_cast("int"))
    numbers = split.select(number.alias("number")).filter(F.col("number").isNotNull())
    return numbers.groupBy("number").agg(F.count("*").alias("n"))


@query(
    "fn_parse_ts",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS parsed FROM orders",
)
def fn_parse_ts(t):
    text = F.when(F.col("o_orderstatus") == "F", "unknown").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    parsed = C.parse_time(text, "dd/MM/yyyy").cast("timestamp_ntz")
    return t.orders.select("o_orderkey", parsed.alias("parsed"))


@query("fn_parse_ts_ampm", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def fn_parse_ts_ampm(t):
    pattern = "MM/dd/yyyy hh:mm:ss a"
    text = F.date_format("ts", pattern)
    return t.events.select("event_id", C.parse_time(text, pattern).cast("timestamp_ntz").alias("parsed"))


@query(
    "fn_year_of",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(2002 - year(o_orderdate) AS INTEGER) AS age
    FROM orders WHERE 2002 - year(o_orderdate) > 4""",
)
def fn_year_of(t):
    year = C.year_of(F.col("o_orderdate"))
    df = t.orders.select("o_orderkey", year.alias("year"), (2002 - year).alias("age"))
    return df.filter(F.col("age") > 4)


@query("map_partitions_sqrt", "SELECT p_partkey, round(sqrt(p_size), 6) AS root FROM part")
def map_partitions_sqrt(t):
    def connect():
        import numpy

        return numpy

    def use(numpy, batch):
        roots = numpy.sqrt(batch["p_size"].astype("float64")).round(6)
        return batch[["p_partkey"]].assign(root=roots)

    return map_partitions(t.part.select("p_partkey", "p_size"), connect, use, "p_partkey long, root double")


@query(
    "fn_log_exp",
    "SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price, round(exp(ln(o_totalprice)), 2) AS price FROM orders",
)
def fn_log_exp(t):
    log = F.log("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.round(log, 6).alias("log_price"), F.round(F.exp(log), 2).alias("price")
    )


@query(
    "fn_explode_categories",
    "SELECT c_custkey, category FROM customer CROSS JOIN (VALUES ('Low'), ('Medium'), ('High')) v(category)",
)
def fn_explode_categories(t):
    categories = F.array(F.lit("Low"), F.lit("Medium"), F.lit("High"))
    return t.customer.select("c_custkey", F.explode(categories).alias("category"))


@query(
    "fn_to_json",
    """SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS value
    FROM part""",
)
def fn_to_json(t):
    df = t.part.select("p_partkey", "p_name", "p_size")
    return df.select("p_partkey", F.to_json(F.struct("*")).alias("value"))


@query(
    "tiered_cost",
    """SELECT o_orderkey, o_custkey, o_totalprice,
        round(CASE WHEN o_totalprice > 250000 THEN o_totalprice * 0.15 ELSE o_totalprice * 0.5 END, 4) AS cost FROM orders""",
)
def tiered_cost(t):
    cost = F.round(C.tiered_cost(F.col("o_totalprice"), 250000, 0.15, 0.5), 4)
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", cost.alias("cost"))


@query(
    "scale_nullable",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 20 END AS scaled FROM orders",
)
def scale_nullable(t):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return t.orders.select("o_orderkey", (known * 20).alias("scaled"))


@query(
    "flatmap_double",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
    UNION ALL SELECT c_custkey, c_name, c_acctbal * 0.3 FROM customer""",
)
def flatmap_double(t):
    return with_scaled_copy(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", 0.3)


@query("udf_bucket", BUCKET_SQL)
def udf_bucket(t):
    @F.pandas_udf(T.StringType())
    def classify(delay):
        import numpy
        import pandas

        edges = [edge for edge, _ in DELAY_EDGES]
        labels = numpy.array([label for _, label in DELAY_EDGES] + [BEYOND_EDGES], dtype=object)
        found = pandas.Series(labels[numpy.searchsorted(edges, delay.to_numpy(dtype="float64"))])
        return found.where(delay.notna().to_numpy(), None)

    return delays(t).withColumn("delay_class", classify("delay"))
