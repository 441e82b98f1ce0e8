"""Versions in a folder: reading as of, repeated and broken writes, compaction, history."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import types as T

from weftline.operators.versions import VersionedTable
from weftline.session import scratch

LOANS = T.StructType(
    [
        T.StructField("loan_id", T.LongType()),
        T.StructField("funded", T.IntegerType()),
        T.StructField("paid", T.DoubleType()),
        T.StructField("state", T.StringType()),
    ]
)


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch(spark, "loans"), LOANS, ("loan_id",))


def loans(spark, *data):
    return spark.createDataFrame(list(data), LOANS)


def test_versions_without_keys(spark):
    """Append repeats rows, overwrite replaces all; every version stays readable."""
    t = VersionedTable(spark, scratch(spark, "numbers"), spark.range(1).schema)
    assert t.read().count() == 0 and t.latest() is None and t.history().count() == 0
    assert t.append(spark.range(0, 3)) == 0
    assert t.append(spark.range(8, 11)) == 1
    assert t.append(spark.range(8, 9)) == 2
    assert t.overwrite(spark.createDataFrame([(55,), (66,), (77,)], "id LONG")) == 3
    numbers = [[r.id for r in t.read(v).orderBy("id").collect()] for v in range(4)]
    assert numbers == [[0, 1, 2], [0, 1, 2, 8, 9, 10], [0, 1, 2, 8, 8, 9, 10], [55, 66, 77]]
    assert rows(t.read()) == [(55,), (66,), (77,)]
    t.update("id = 55", {"id": "id + 1"})
    t.delete("id > 70")
    assert rows(t.read()) == [(56,), (66,)] and rows(t.read(3)) == [(55,), (66,), (77,)]


def test_a_repeated_write_leaves_one_version(spark, table):
    table.append(loans(spark, (1, 10, 1.0, "CA"), (2, 20, 2.0, "TX")))
    for data in ([(3, 30, 3.0, "NY"), (4, 40, None, None)], [(3, 31, 3.0, "NY")], []):
        assert table.append(loans(spark, *data), version=1) == 1
        assert rows(table.read()) == sorted([(1, 10, 1.0, "CA"), (2, 20, 2.0, "TX"), *data], key=repr)
    assert [r.rows_written for r in table.history().orderBy("version").collect()] == [2, 0]


def test_a_broken_write_is_not_seen(spark, table):
    table.append(loans(spark, (1, 10, 1.0, "CA")))
    # What a job leaves that dies between the data and its history row.
    loans(spark, (9, 90, 9.0, "NV")).selectExpr("*", "'put' AS op").write.parquet(f"{table.path}/log/version=1")
    assert rows(table.read()) == [(1, 10, 1.0, "CA")] and table.latest() == 0
    assert table.append(loans(spark, (2, 20, 2.0, "TX"))) == 1
    assert rows(table.read()) == [(1, 10, 1.0, "CA"), (2, 20, 2.0, "TX")]


def test_compaction_leaves_older_files_alone(spark, table):
    for n in range(4):
        table.append(loans(spark, (n, n, float(n), "CA"), (100, n, None, "TX")))
    before = [rows(table.read(v)) for v in range(4)]
    assert table.compact(2) == 2
    assert [rows(table.read(v)) for v in range(4)] == before
    files = table.read().inputFiles()
    assert files and all("snapshots/version=2" in f or "log/version=3" in f for f in files)
    assert all("snapshots/version=2" in f for f in table.read(2).inputFiles())
    table.overwrite(loans(spark, (7, 7, 7.0, "AL")))
    assert all("log/version=4" in f for f in table.read().inputFiles())
    table.compact()
    table.delete("loan_id = 7")
    assert rows(table.read()) == [] and rows(table.read(4)) == [(7, 7, 7.0, "AL")]


def test_history_counts_and_parameters(spark, table):
    table.overwrite(loans(spark, *((n, n * 10, float(n), "CA") for n in range(10))))
    table.update("loan_id >= 6", {"state": "'TX'", "funded": "funded + 1"})
    table.delete("state = 'TX' AND funded > 80")
    table.append(loans(spark, (0, 5, None, None), (50, 5, None, None)))
    found = [tuple(r)[1:3] + tuple(r)[4:] for r in table.history().orderBy("version").collect()]
    assert found == [
        ("OVERWRITE", {}, 0, 10, 0, 0),
        ("UPDATE", {"predicate": "loan_id >= 6", "set state": "'TX'", "set funded": "funded + 1"}, 10, 4, 4, 0),
        ("DELETE", {"predicate": "state = 'TX' AND funded > 80"}, 10, 0, 0, 2),
        ("MERGE", {}, 0, 2, 0, 0),
    ]
    assert table.read().count() == 9


def test_reading_by_time(spark, table):
    day = lambda d: datetime.datetime(2024, 5, d, tzinfo=datetime.timezone.utc)
    table.append(loans(spark, (1, 1, 1.0, "CA")), at=day(1))
    table.append(loans(spark, (2, 2, 2.0, "CA")), at=day(3))
    assert [table.read(as_of=day(d)).count() for d in (1, 2, 3, 9)] == [1, 1, 2, 2]
    assert table.read(as_of=datetime.datetime(2000, 1, 1)).count() == 0


def test_refused_writes(spark, table):
    table.append(loans(spark, (1, 1, 1.0, "CA")), version=3)
    with pytest.raises(ValueError, match="before the newest"):
        table.append(loans(spark, (2, 1, 1.0, "CA")), version=2)
    with pytest.raises(ValueError, match="cannot write"):
        table.append(spark.range(3))
    with pytest.raises(ValueError, match="key"):
        table.update("true", {"loan_id": "1"})
    with pytest.raises(Exception, match="several source rows"):
        table.append(loans(spark, (5, 1, 1.0, "CA"), (5, 2, 1.0, "CA")))
    with pytest.raises(Exception, match="key is null"):
        table.append(loans(spark, (None, 1, 1.0, "CA")))
    assert rows(table.read()) == [(1, 1, 1.0, "CA")] and table.latest() == 3
