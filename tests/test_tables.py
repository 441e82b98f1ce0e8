"""Row changes, snapshots, schemas, readers, writers and column functions."""

import dataclasses
import datetime
import decimal
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import columns as C
from weftline.operators import filters, lake
from weftline.operators.aggregates import chi_square, pivot_named, summary, top_n_array
from weftline.schemas import Int, require_schema, schema_of
from weftline.session import reuse, scratch, settle
from weftline.sources import readers, writers

LOAN = "loan_id BIGINT, funded INT, paid DOUBLE, state STRING"


@pytest.fixture(scope="module")
def loans(spark):
    data = [(1, 1000, 1000.0, "CA"), (2, 2500, 500.0, "OR"), (3, 300, None, "WA")]
    return spark.createDataFrame(data, LOAN)


def test_update_and_delete_treat_null_as_false(loans):
    changed = lake.update(loans, F.col("paid") < 600, {"state": F.lit("XX")})
    assert rows(changed, "loan_id", "state") == [(1, "CA"), (2, "XX"), (3, "WA")]
    assert rows(lake.delete(loans, F.expr("funded = paid")), "loan_id") == [(2,), (3,)]


def test_upsert_and_insert_new(spark, loans):
    source = spark.createDataFrame([(2, 2500, 900.0, "CA"), (9, 10, 1.0, "PL")], LOAN)
    merged = lake.upsert(loans, source, ["loan_id"])
    assert rows(merged, "loan_id", "paid") == [(1, 1000.0), (2, 900.0), (3, None), (9, 1.0)]
    added = lake.insert_new(loans, source, ["loan_id"])
    assert rows(added, "loan_id", "paid") == [(1, 1000.0), (2, 500.0), (3, None), (9, 1.0)]


def test_upsert_rejects_repeated_source_keys(spark, loans):
    source = spark.createDataFrame([(2, 1, 1.0, "CA"), (2, 2, 2.0, "CA")], LOAN)
    with pytest.raises(Exception, match="several source rows"):
        lake.upsert(loans, source, ["loan_id"]).collect()


def test_merge_clauses_in_order(spark, loans):
    source = spark.createDataFrame(
        [(1, 0, 0.0, "gone"), (2, 7, 7.0, "AU"), (8, 1, 1.0, "in"), (9, 2, 2.0, "out")], LOAN
    )
    clauses = [
        lake.Clause("delete", when="s.state = 'gone'"),
        lake.Clause("update", when="s.paid > t.paid", values={"paid": "s.paid"}),
        lake.Clause("update", values={"state": "s.state", "funded": "t.funded + s.funded"}),
        lake.Clause("insert", when="s.state = 'in'"),
    ]
    assert rows(lake.merge(loans, source, ["loan_id"], clauses)) == [
        (2, 2507, 500.0, "AU"), (3, 300, None, "WA"), (8, 1, 1.0, "in"),
    ]
    with pytest.raises(ValueError, match="unknown merge clause"):
        lake.merge(loans, source, ["loan_id"], [lake.Clause("replace")])


def test_appending_checks_or_evolves_the_schema(spark, loans):
    wider = spark.createDataFrame([(4, 1, 1.0, "CA", True)], LOAN + ", closed BOOLEAN")
    with pytest.raises(ValueError, match="unexpected closed boolean"):
        lake.append_strict(loans, wider)
    assert rows(lake.append_evolving(loans, wider), "loan_id", "closed") == [
        (1, None), (2, None), (3, None), (4, True),
    ]


def test_snapshots_by_version_and_time(spark):
    day = lambda d: datetime.datetime(2024, 1, d)
    log = spark.createDataFrame(
        [
            (0, day(1), "put", "a", 1), (0, day(1), "put", "b", 1), (1, day(2), "put", "a", 2),
            (1, day(2), "delete", "b", None), (2, day(3), "overwrite", "c", 9), (3, day(4), "put", "a", 4),
        ],
        "version BIGINT, commit_ts TIMESTAMP, op STRING, k STRING, v INT",
    )
    at = lambda v: rows(lake.snapshot(log, ["k"], version=v))
    assert at(0) == [("a", 1), ("b", 1)]
    assert at(1) == [("a", 2)]
    assert at(2) == [("c", 9)]
    assert at(3) == rows(lake.snapshot(log, ["k"])) == [("a", 4), ("c", 9)]
    assert rows(lake.snapshot(log, ["k"], as_of=F.lit(day(2)))) == [("a", 2)]
    assert [r["version"] for r in lake.history(log, 2).collect()] == [3, 2]


def test_create_empty_keeps_an_existing_table(spark, loans):
    path = scratch(spark, "empty")
    assert lake.create_empty(path, loans.schema, spark).count() == 0
    loans.write.mode("append").parquet(path)
    assert lake.create_empty(path, loans.schema, spark).count() == 3


# ---- schemas, readers, writers ----


@dataclasses.dataclass
class Inner:
    x: float


@dataclasses.dataclass
class Record:
    id: decimal.Decimal
    name: str
    size: Int
    age: int | None
    tags: list[str]
    at: datetime.datetime
    inner: Inner


def test_schema_of_a_dataclass():
    found = schema_of(Record)
    assert found.simpleString() == (
        "struct<id:decimal(38,0),name:string,size:int,age:bigint,tags:array<string>,at:timestamp,inner:struct<x:double>>"
    )
    assert found["age"].nullable and not found["name"].nullable


def test_schema_check_lists_all_differences(spark):
    df = spark.createDataFrame([(1, "a")], "a INT, c STRING")
    with pytest.raises(ValueError, match="missing b int; unexpected c string; a is int, not bigint"):
        require_schema(df, T.StructType.fromDDL("a BIGINT, b INT"))


def test_file_sources_drop_not_null(spark):
    df = spark.range(3)
    path = writers.write_parquet(df, scratch(spark, "p"))
    assert not df.schema["id"].nullable and spark.read.parquet(path).schema["id"].nullable


def test_csv_keeps_quotes_line_breaks_and_blanks(spark):
    values = ['say "hi", ok', "two\nlines", "  padded  ", "plain"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    path = writers.write_csv(df, scratch(spark, "csv"))
    assert rows(readers.read_csv(spark, path, df.schema, multiline=True)) == rows(df)


def test_tab_text_with_bare_carriage_returns(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"City\tIATA\rAbbotsford\tYXX\rAberdeen\tABR\r")
    read = readers.read_csv(spark, str(tmp_path), "City STRING, IATA STRING", separator="\t")
    assert rows(read) == [("Abbotsford", "YXX"), ("Aberdeen", "ABR")]


def test_tables_are_not_replaced_unasked(spark):
    name = f"t_{scratch(spark, 'x')[-12:]}"
    writers.write_table(spark.range(2), name, scratch(spark, "t"))
    with pytest.raises(Exception, match="already exists"):
        writers.write_table(spark.range(2), name, scratch(spark, "t"))


def test_report_is_one_file(spark):
    path = writers.write_report_csv(spark.range(100).repartition(5), scratch(spark, "report"))
    assert len(spark.read.option("header", True).csv(path).inputFiles()) == 1


def test_write_many_raises_the_error_of_a_part(spark):
    bad = spark.range(2).select(F.raise_error("broken").cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        writers.write_many({scratch(spark, "good"): spark.range(2), scratch(spark, "bad"): bad})


def test_reuse_always_releases(spark):
    df = spark.range(5)
    with pytest.raises(RuntimeError), reuse(df) as kept:
        assert kept.is_cached
        raise RuntimeError
    assert not df.is_cached


def test_settle_cuts_the_lineage(spark):
    df = settle(spark.range(5).withColumn("r", F.rand()))
    assert rows(df) == rows(df) and "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_scratch_paths_are_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch(spark, "a"), scratch(spark, "a")
    assert first != second
    if named:
        assert first.startswith(named)


# ---- columns, filters, aggregates ----


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


@pytest.mark.parametrize(
    "delay, label",
    [(-5, "Early"), (0, "No"), (1, "Some"), (60, "Some"), (61, "Long"), (360, "Long"), (361, "Beyond")],
)
def test_bucket_edges_adjoin(spark, delay, label):
    edges = [(-1e-9, "Early"), (0, "No"), (60, "Some"), (360, "Long")]
    assert one(spark, C.bucketize(F.col("x"), edges, "Beyond"), x=delay) == label


def test_bucket_of_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "x INT").select(C.bucketize(F.col("x"), [(0, "a")], "b"))
    assert df.first()[0] is None


def test_tolerant_parsing(spark):
    assert one(spark, C.parse_money(F.col("x")), x="$1,200.50") == 1200.5
    assert one(spark, C.parse_money(F.col("x")), x="free") is None
    parsed = C.parse_time(F.col("x"), "dd/MM/yyyy")
    assert one(spark, parsed, x="02/01/2021") == datetime.datetime(2021, 1, 2)
    assert one(spark, parsed, x="2021-01-02") is None
    field = C.split_field(F.col("x"), "#", 2, "int")
    assert one(spark, field, x="t#12") == 12
    assert one(spark, field, x="t") is None and one(spark, field, x="t#b") is None


def test_words_drop_trailing_blanks_only(spark):
    assert one(spark, C.words(F.col("x")), x=" a  b  ") == ["", "a", "", "b"]


def test_iso_week_of_new_years_eve(spark):
    assert one(spark, F.weekofyear(F.col("x").cast("date")), x="2018-12-31") == 1


def test_hash_split_is_a_partition(spark):
    train, test = C.hash_split(spark.range(2000), "id", 80)
    again, _ = C.hash_split(spark.range(2000).repartition(7), "id", 80)
    assert train.count() + test.count() == 2000 and 1500 < train.count() < 1700
    assert rows(train) == rows(again)


def test_null_in_unequal_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x STRING")
    assert df.filter(F.col("x") != "a").count() == 1
    assert df.filter(filters.not_equal_keep_null(F.col("x"), "a")).count() == 2


def test_low_battery_and_high_quantile(spark):
    df = spark.createDataFrame([(v,) for v in [0, 7, 1, 9, 1, 2, 7, 0, 5, 2, 0, 3, 5, 9]], "battery INT")
    assert filters.below_fraction_of_max(df, "battery", 0.2).count() == 5
    assert filters.above_quantile(df, "battery", 0.75).count() == 4


def test_last_days(spark):
    df = spark.createDataFrame([(datetime.datetime(2021, 1, d, 9),) for d in (1, 2, 9)], "ts TIMESTAMP")
    assert filters.last_days(df, "ts", 7).count() == 2
    assert filters.last_days(df, "ts", 7, F.lit("2021-01-10")).count() == 1


def test_pivot_names(spark):
    df = spark.createDataFrame([("SFO", 1, 10), ("SFO", 1, 5), ("SFO", 2, 3)], "d STRING, m INT, x INT")
    both = pivot_named(df, ["d"], "m", {1: "JAN", 2: "FEB"}, {"Avg": F.avg("x"), "Max": F.max("x")})
    assert both.first().asDict() == {"d": "SFO", "JAN_Avg": 7.5, "JAN_Max": 10, "FEB_Avg": 3.0, "FEB_Max": 3}
    single = pivot_named(df, ["d"], "m", {1: "JAN"}, {"Max": F.max("x")})
    assert single.first().asDict() == {"d": "SFO", "JAN_Max": 10}


def test_top_n_and_summary(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaac"], "x STRING")
    assert top_n_array(df, "x", 2, "top").first()["top"] == ["a", "b"]
    found = summary(spark.range(1, 11), ["id"]).first()
    assert (found["n"], found["mean"], found["min"], found["max"]) == (10, 5.5, 1.0, 10.0)
    assert (found["q25"], found["q50"], found["q75"]) == (3.0, 5.0, 8.0)


def test_approximate_distinct_is_near(spark):
    n = spark.range(20000).agg(F.approx_count_distinct("id", 0.02)).first()[0]
    assert abs(n - 20000) < 20000 * 0.06


def test_chi_square_of_independent_columns(spark):
    df = spark.range(120).selectExpr("cast(id % 3 AS string) AS a", "cast(id % 4 AS string) AS b")
    found = chi_square(df, "a", "b").first()
    assert found["degrees_of_freedom"] == 6 and found["statistic"] == pytest.approx(0)


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = df.filter(F.col("l_quantity") > 30).select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,30.0)" in text and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_sql_and_dataframe_give_the_same_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    df.createOrReplaceTempView("same_plan_orders")
    by_sql = spark.sql("SELECT o_orderkey FROM same_plan_orders WHERE o_totalprice > 1000 ORDER BY o_orderkey DESC")
    by_api = df.select("o_orderkey").where(df.o_totalprice > 1000).orderBy(F.col("o_orderkey").desc())
    shapes = [
        re.sub(r"#\d+L?|plan_id=\d+", "", d._jdf.queryExecution().executedPlan().toString())
        for d in (by_sql, by_api)
    ]
    assert shapes[0] == shapes[1]
