"""Sources and sinks: each query writes a given table in some format and reads it back."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.columns import words
from weftline.operators.sets import union_all
from weftline.plans.registry import query
from weftline.schemas import Customer, Order, schema_of
from weftline.session import reuse, scratch, settle
from weftline.sources import readers, writers
from weftline.streaming.run import settings


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query("src_csv_schema", "SELECT * FROM customer")
def src_csv_schema(t):
    path = writers.write_csv(t.customer, scratch(t.spark, "csv"))
    return readers.read_csv(t.spark, path, schema_of(Customer))


@query("src_csv_ddl", "SELECT * FROM supplier")
def src_csv_ddl(t):
    path = writers.write_csv(t.supplier, scratch(t.spark, "csv"))
    ddl = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    return readers.read_csv(t.spark, path, ddl)


@query(
    "src_csv_infer",
    """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
    FROM part""",
)
def src_csv_infer(t):
    path = writers.write_csv(t.part, scratch(t.spark, "csv"))
    return readers.read_csv(t.spark, path)


@query("src_csv_multiline", "SELECT page_id, url, html FROM pages")
def src_csv_multiline(t):
    path = writers.write_csv(t.pages, scratch(t.spark, "csv"))
    return readers.read_csv(t.spark, path, t.pages.schema, multiline=True)


@query("src_tsv", "SELECT * FROM supplier")
def src_tsv(t):
    path = writers.write_csv(t.supplier, scratch(t.spark, "tsv"), separator="\t")
    return readers.read_csv(t.spark, path, t.supplier.schema, separator="\t")


@query(
    "src_json_array",
    """SELECT conv_id, turn, len(w) AS n_words, w[1] AS first_word
    FROM (SELECT conv_id, turn, string_split(rtrim(text, ' '), ' ') AS w FROM conversations)""",
)
def src_json_array(t):
    rows = t.conversations.select("conv_id", "turn", words(F.col("text")).alias("words"))
    path = writers.write_json(rows, scratch(t.spark, "json"))
    schema = T.StructType(
        [
            T.StructField("conv_id", T.LongType(), False),
            T.StructField("turn", T.LongType(), False),
            T.StructField("words", T.ArrayType(T.StringType()), True),
        ]
    )
    read = readers.read_json(t.spark, path, schema)
    return read.select(
        "conv_id", "turn", F.size("words").cast("long").alias("n_words"), F.col("words")[0].alias("first_word")
    )


@query(
    "src_json_infer",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer""",
)
def src_json_infer(t):
    path = writers.write_json(t.customer, scratch(t.spark, "json"))
    # Inference knows no INT: whole numbers come back as BIGINT.
    expected = "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING"
    return readers.read_json(t.spark, path, T.StructType.fromDDL(expected), infer=True)


@query(
    "src_json_class",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
)
def src_json_class(t):
    rows = t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return readers.read_json(t.spark, writers.write_json(rows, scratch(t.spark, "json")), Order)


@query("src_parquet", "SELECT * FROM lineitem")
def src_parquet(t):
    return readers.read_parquet(t.spark, t.path("lineitem"))


@query("src_table", "SELECT * FROM customer")
def src_table(t):
    name = writers.write_table(t.customer, _name("customer"), scratch(t.spark, "table"))
    return t.spark.table(name)


@query(
    "src_local",
    """SELECT level, count(*) AS n, round(sum(o_totalprice * weight), 2) AS weighted
    FROM orders JOIN (VALUES ('1-URGENT', 'high', 5), ('2-HIGH', 'high', 4), ('3-MEDIUM', 'normal', 3),
        ('4-NOT SPECIFIED', 'normal', 2), ('5-LOW', 'low', 1)) AS v(priority, level, weight)
    ON o_orderpriority = priority GROUP BY level""",
)
def src_local(t):
    levels = readers.local_rows(
        t.spark,
        [
            ("1-URGENT", "high", 5),
            ("2-HIGH", "high", 4),
            ("3-MEDIUM", "normal", 3),
            ("4-NOT SPECIFIED", "normal", 2),
            ("5-LOW", "low", 1),
        ],
        "priority STRING, level STRING, weight INT",
    )
    return (
        t.orders.join(F.broadcast(levels), F.col("o_orderpriority") == F.col("priority"))
        .groupBy("level")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum(F.col("o_totalprice") * F.col("weight")), 2).alias("weighted"),
        )
    )


@query(
    "src_range",
    """SELECT r.id, r.id * r.id AS square, o_totalprice
    FROM (SELECT range AS id FROM range((SELECT max(o_orderkey) + 1 FROM orders))) r
    JOIN orders ON o_orderkey = r.id""",
)
def src_range(t):
    end = t.orders.agg(F.max("o_orderkey")).first()[0] + 1
    numbers = readers.number_range(t.spark, 0, end).withColumn("square", F.col("id") * F.col("id"))
    joined = numbers.join(t.orders, F.col("id") == F.col("o_orderkey"))
    return joined.select("id", "square", "o_totalprice")


@query(
    "src_synth_usage",
    """SELECT c_custkey AS uid, 'user-' || c_custkey AS uname,
        CAST(CAST('0x' || substr(md5(c_custkey || '|42'), 1, 8) AS BIGINT) % 1000 AS INTEGER) AS usage FROM customer""",
)
def src_synth_usage(t):
    return readers.synthetic_usage(t.customer, "c_custkey")


@query(
    "sql_view",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue FROM lineitem
    WHERE l_quantity > 25 GROUP BY l_returnflag ORDER BY l_returnflag""",
)
def sql_view(t):
    view = _name("lineitem")
    t.lineitem.createOrReplaceTempView(view)
    return t.spark.sql(
        f"""SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue FROM {view}
        WHERE l_quantity > :quantity GROUP BY l_returnflag ORDER BY l_returnflag""",
        args={"quantity": 25},
    )


_ORDER_TYPES = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]


@query(
    "catalog_columns",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{k}' AS data_type, "
        f"count({c}) AS n_values FROM orders"
        for i, (c, k) in enumerate(_ORDER_TYPES)
    ),
)
def catalog_columns(t):
    view = _name("orders")
    t.orders.createOrReplaceTempView(view)
    listing = readers.column_listing(t.spark, view)
    table = t.spark.table(view)
    counts = table.agg(*[F.count(c).alias(c) for c in table.columns])
    filled = counts.unpivot([], table.columns, "column_name", "n_values")
    return listing.join(filled, "column_name").select("position", "column_name", "data_type", "n_values")


@query(
    "catalog_tables",
    """SELECT 'default' AS database_name, 'supplier' AS of, false AS is_temporary, 4 AS n_columns, count(*) AS n_rows FROM supplier
    UNION ALL SELECT NULL, 'nation', true, 2, count(*) FROM nation""",
)
def catalog_tables(t):
    """Databases and their tables as the catalog lists them: a stored table and a view, with their rows."""
    mark = uuid.uuid4().hex[:8]
    suppliers = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    writers.write_table(suppliers, f"listed_{mark}_supplier", scratch(t.spark, "table"))
    t.nation.select("n_nationkey", "n_name").createOrReplaceTempView(f"listed_{mark}_nation")
    databases = readers.database_listing(t.spark).select("database_name")
    tables = readers.table_listing(t.spark, "default", f"listed_{mark}_*")
    known = tables.join(databases, "database_name", "left_semi").unionByName(tables.filter("database_name IS NULL"))
    sizes = [
        t.spark.table(f"listed_{mark}_{x}").agg(F.count("*").alias("n_rows")).select(F.lit(x).alias("of"), "n_rows")
        for x in ("supplier", "nation")
    ]
    named = known.withColumn("of", F.element_at(F.split("table_name", "_"), -1))
    return named.join(union_all(sizes), "of").select("database_name", "of", "is_temporary", "n_columns", "n_rows")


@query("snk_parquet", "SELECT * FROM orders")
def snk_parquet(t):
    path = writers.write_parquet(t.orders, scratch(t.spark, "parquet"), mode="overwrite")
    return t.spark.read.parquet(path)


@query("snk_table", "SELECT * FROM supplier")
def snk_table(t):
    return t.spark.table(writers.write_table(t.supplier, _name("supplier"), scratch(t.spark, "table")))


@query("snk_bucketed", "SELECT * FROM customer")
def snk_bucketed(t):
    path, buckets = scratch(t.spark, "bucketed"), writers.bucket_count(t.customer.count())
    return t.spark.table(writers.write_bucketed(t.customer, _name("customer"), path, buckets, ["c_custkey"]))


@query(
    "snk_csv_single",
    """SELECT r_name, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def snk_csv_single(t):
    report = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    path = writers.write_report_csv(report, scratch(t.spark, "report"))
    return readers.read_csv(t.spark, path, "r_name STRING, n BIGINT, total DOUBLE")


@query("snk_json", "SELECT * FROM supplier")
def snk_json(t):
    path = writers.write_json(t.supplier, scratch(t.spark, "json"))
    return readers.read_json(t.spark, path, t.supplier.schema)


@query(
    "snk_parallel",
    """SELECT 'priority' AS result, o_orderpriority AS name, count(*) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY ALL
    UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY ALL""",
)
def snk_parallel(t):
    groups = {
        "priority": F.col("o_orderpriority"),
        "status": F.col("o_orderstatus"),
        "year": F.year("o_orderdate").cast("string"),
    }
    frames = {
        scratch(t.spark, name): t.orders.groupBy(column.alias("name"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("result"), "name", "n")
        for name, column in groups.items()
    }
    written = writers.write_many(frames)
    return union_all([t.spark.read.parquet(path) for path in written])


@query("snk_files", "SELECT CAST(4 AS BIGINT) AS n_files, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders")
def snk_files(t):
    """The number of files is what the writer was asked for."""
    path = writers.write_parquet(t.orders, scratch(t.spark, "files"), files=4)
    written = t.spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    return written.agg(F.count_distinct("file").alias("n_files"), F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


_KEPT = """SELECT o_orderpriority AS name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_totalprice > 100000 GROUP BY ALL UNION ALL SELECT o_orderstatus, count(*), round(sum(o_totalprice), 2) FROM orders
    WHERE o_totalprice > 100000 GROUP BY ALL"""


def _kept(t, level):
    """Two reports over rows that are filtered once and kept at the given level until both are written."""
    with reuse(t.orders.filter(F.col("o_totalprice") > 100_000), level) as rows:
        reports = [
            rows.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
            for c in ("o_orderpriority", "o_orderstatus")
        ]
        return settle(union_all(reports), "kept")


@query("job_cache", _KEPT)
def job_cache(t):
    return _kept(t, StorageLevel.MEMORY_AND_DISK)


@query("job_persist_disk", _KEPT)
def job_persist_disk(t):
    return _kept(t, StorageLevel.DISK_ONLY)


@query("job_shuffle_partitions", "SELECT CAST(5 AS BIGINT) AS n_partitions, count(DISTINCT o_custkey) AS n_keys, count(*) AS n FROM orders")
def job_shuffle_partitions(t):
    """A shuffle has as many partitions as the session says at the time it runs, if AQE does not merge them."""
    wanted = {"spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(t.spark, wanted):
        counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
        counts = settle(counts.withColumn("place", F.spark_partition_id()), "counts")
    return counts.agg(F.count_distinct("place").alias("n_partitions"), F.count("*").alias("n_keys"), F.sum("n").alias("n"))
