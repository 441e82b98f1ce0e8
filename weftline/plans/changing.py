"""Row changes, merges and snapshots by version or time."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from weftline.operators import lake
from weftline.operators.versions import VersionedTable
from weftline.plans.registry import query
from weftline.session import scratch

_LOANS = """(SELECT o_orderkey AS loan_id, o_totalprice AS funded,
        CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN o_totalprice / 2 END AS paid,
        CASE WHEN o_orderpriority = '1-URGENT' THEN false END AS closed FROM orders)"""


def loans(t):
    """Orders as loans: F is paid in full, O by half, P has no payment; few have a closed flag."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("loan_id"),
        price.alias("funded"),
        F.when(status == "F", price).when(status == "O", price / 2).alias("paid"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).alias("closed"),
    )


@query(
    "lake_update",
    f"""SELECT loan_id, funded, CAST(CASE WHEN closed IS NULL THEN funded - paid = 0 ELSE closed END AS VARCHAR) AS closed
    FROM {_LOANS}""",
)
def lake_update(t):
    paid_off = F.col("funded") - F.col("paid") == 0
    changed = lake.update(loans(t), F.col("closed").isNull(), {"closed": paid_off})
    return changed.select("loan_id", "funded", F.col("closed").cast("string").alias("closed"))


@query("lake_delete", f"SELECT loan_id, funded, paid FROM {_LOANS} WHERE NOT coalesce(funded = paid, false)")
def lake_delete(t):
    kept = lake.delete(loans(t), F.col("funded") == F.col("paid"))
    return kept.select("loan_id", "funded", "paid")


# New keys lie above all customer keys.
_NEW = "c_custkey + (SELECT max(c_custkey) + 1 FROM customer)"
_UPDATES = f"""(SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT {_NEW}, c_name, c_acctbal, 'NEW' FROM customer WHERE c_mktsegment = 'MACHINERY')"""
_BALANCES = "(SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer)"


def balances(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def balance_updates(t):
    """Changed rows of one segment and copies of another under new keys."""
    rows = balances(t)
    changed = rows.filter(F.col("c_mktsegment") == "BUILDING")
    changed = changed.withColumn("c_acctbal", F.col("c_acctbal") + 100)
    shift = t.customer.agg((F.max("c_custkey") + 1).alias("s")).scalar()
    added = rows.filter(F.col("c_mktsegment") == "MACHINERY")
    added = added.withColumn("c_custkey", F.col("c_custkey") + shift)
    return changed.unionByName(added.withColumn("c_mktsegment", F.lit("NEW")))


@query(
    "lake_upsert",
    f"""SELECT * FROM {_BALANCES} WHERE c_custkey NOT IN (SELECT c_custkey FROM {_UPDATES})
    UNION ALL SELECT * FROM {_UPDATES}""",
)
def lake_upsert(t):
    return lake.upsert(balances(t), balance_updates(t), ["c_custkey"])


@query(
    "lake_insert_new",
    f"""SELECT * FROM {_BALANCES}
    UNION ALL SELECT * FROM {_UPDATES} WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def lake_insert_new(t):
    return lake.insert_new(balances(t), balance_updates(t), ["c_custkey"])


@query(
    "lake_merge_clauses",
    f"""SELECT t.c_custkey, t.c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, t.c_mktsegment
    FROM {_BALANCES} t LEFT JOIN {_UPDATES} s ON t.c_custkey = s.c_custkey
    WHERE NOT (s.c_custkey IS NOT NULL AND s.c_acctbal < 0)
    UNION ALL SELECT s.c_custkey, s.c_name, s.c_acctbal, s.c_mktsegment FROM {_UPDATES} s
    WHERE s.c_custkey NOT IN (SELECT c_custkey FROM customer) AND s.c_acctbal > 1000""",
)
def lake_merge_clauses(t):
    clauses = [
        lake.Clause("delete", when="s.c_acctbal < 0"),
        lake.Clause("update", values={"c_acctbal": "s.c_acctbal"}),
        lake.Clause("insert", when="s.c_acctbal > 1000"),
    ]
    return lake.merge(balances(t), balance_updates(t), ["c_custkey"], clauses)


@query(
    "lake_merge_schema",
    f"""SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS origin FROM customer
    UNION ALL SELECT c_custkey, c_name, 'update' FROM {_UPDATES}""",
)
def lake_merge_schema(t):
    new = balance_updates(t).select("c_custkey", "c_name", F.lit("update").alias("origin"))
    return lake.append_evolving(t.customer.select("c_custkey", "c_name"), new)


def event_log(t):
    """Events as a change log: one version per day, errors delete, version 10 replaces everything."""
    day = F.datediff("ts", F.lit("2023-12-31")).cast("bigint")
    op = (
        F.when(day == 10, "overwrite")
        .when(F.col("event_type") == "error", "delete")
        .otherwise("put")
    )
    return t.events.select(
        "user_id", "event_id", "event_type", "value",
        day.alias("version"), F.col("ts").alias("commit_ts"), op.alias("op"),
    )


_DAY = "date_diff('day', DATE '2023-12-31', CAST(ts AS DATE))"
_LOG = f"""(SELECT user_id, event_id, event_type, value, {_DAY} AS version, ts AS commit_ts,
    CASE WHEN {_DAY} = 10 THEN 'overwrite' WHEN event_type = 'error' THEN 'delete' ELSE 'put' END AS op FROM events)"""
_SNAPSHOT = f"""SELECT user_id, event_type, value FROM (SELECT *,
        row_number() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) AS place FROM {_LOG}
        WHERE {{0}} AND version >= (SELECT coalesce(max(version), -1) FROM {_LOG} WHERE op = 'overwrite' AND {{0}}))
    WHERE place = 1 AND op <> 'delete'"""


@query("lake_version_as_of", _SNAPSHOT.format("version <= 15"))
def lake_version_as_of(t):
    return lake.snapshot(event_log(t), ["user_id"], version=15, order_within="event_id")


_COMMITTED = f"""version <= (SELECT max(version) FROM (SELECT version, max(commit_ts) AS committed FROM {_LOG} GROUP BY version)
    WHERE committed <= TIMESTAMP '2024-01-09 12:00:00')"""


@query("lake_timestamp_as_of", _SNAPSHOT.format(_COMMITTED))
def lake_timestamp_as_of(t):
    time = F.lit("2024-01-09 12:00:00").cast("timestamp_ntz")
    return lake.snapshot(event_log(t), ["user_id"], as_of=time, order_within="event_id")


@query(
    "lake_history",
    f"""SELECT version, max(commit_ts) AS commit_ts, string_agg(DISTINCT op, '+' ORDER BY op) AS operation,
    count(*) AS entries, count(*) FILTER (op = 'put') AS puts, count(*) FILTER (op = 'delete') AS deletes,
    count(*) FILTER (op = 'overwrite') AS overwrites FROM {_LOG}
    GROUP BY version ORDER BY version DESC LIMIT 25""",
)
def lake_history(t):
    return lake.history(event_log(t), 25)


@query("lake_create_empty", "SELECT * FROM orders")
def lake_create_empty(t):
    empty = lake.create_empty(scratch(t.spark, "empty"), t.orders.schema, t.spark)
    return lake.append_strict(empty, t.orders)


# ---- versions in a folder ----

_CLOCK = [datetime.datetime(2024, 1, d, tzinfo=datetime.timezone.utc) for d in range(1, 9)]


def versioned_orders(t):
    """Orders in versions: 0 finished ones, 1 the open ones (written twice), 2 an update, 3 a delete, 4 a few changed rows."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    table = VersionedTable(t.spark, scratch(t.spark, "orders"), rows.schema, ("o_orderkey",))
    table.overwrite(rows.filter("o_orderstatus = 'F'"), at=_CLOCK[0])
    for _ in range(2):
        table.append(rows.filter("o_orderstatus = 'O'"), version=1, at=_CLOCK[1])
    table.update("o_totalprice < 100000", {"o_totalprice": "o_totalprice + 1", "o_orderstatus": "'L'"}, at=_CLOCK[2])
    table.delete("o_totalprice > 300000", at=_CLOCK[3])
    again = rows.filter("o_orderkey % 10 = 0").withColumn("o_orderstatus", F.lit("X"))
    table.append(again, at=_CLOCK[4])
    return table


_V1 = "(SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O'))"
_V2 = f"""(SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'L' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_totalprice < 100000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM {_V1})"""
_V3 = f"(SELECT * FROM {_V2} WHERE o_totalprice <= 300000)"
_V4 = f"""(SELECT * FROM {_V3} WHERE o_orderkey % 10 <> 0
    UNION ALL SELECT o_orderkey, 'X', o_totalprice FROM orders WHERE o_orderkey % 10 = 0)"""


@query("lake_append_version", f"SELECT * FROM {_V4}")
def lake_append_version(t):
    """The newest version, read from a snapshot of version 2 and what came later."""
    table = versioned_orders(t)
    table.compact(2)
    return table.read()


@query("lake_read_version", f"SELECT 1 AS v, * FROM {_V1} UNION ALL SELECT 3, * FROM {_V3}")
def lake_read_version(t):
    """An older version by number, and one by time."""
    table = versioned_orders(t)
    by_time = table.read(as_of=_CLOCK[3] + datetime.timedelta(hours=5))
    return table.read(1).select(F.lit(1).alias("v"), "*").unionByName(by_time.select(F.lit(3).alias("v"), "*"))


@query(
    "lake_overwrite_version",
    f"""SELECT 4 AS v, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM {_V4}
    UNION ALL SELECT 5, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'P'""",
)
def lake_overwrite_version(t):
    """A version that replaces everything, and the one before it, which can still be read."""
    table = versioned_orders(t)
    table.overwrite(t.orders.filter("o_orderstatus = 'P'").select(*table.schema.names), at=_CLOCK[5])
    measures = [F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")]
    before, after = (table.read(v).agg(*measures).select(F.lit(v).alias("v"), "*") for v in (4, 5))
    return before.unionByName(after)


@query(
    "lake_operations",
    f"""WITH n AS (SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS f, (SELECT count(*) FROM {_V1}) AS v1,
        (SELECT count(*) FROM {_V1} WHERE o_totalprice < 100000) AS hit, (SELECT count(*) FROM {_V3}) AS v3,
        (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) AS again)
    SELECT CAST(v AS BIGINT) AS version, operation, parameters, CAST(DATE '2024-01-01' + v AS VARCHAR) AS day, r AS rows_read,
        w AS rows_written, u AS rows_updated, d AS rows_deleted
    FROM (SELECT 0 AS v, 'OVERWRITE' AS operation, '' AS parameters, 0 AS r, f AS w, 0 AS u, 0 AS d FROM n
        UNION ALL SELECT 1, 'MERGE', '', 0, v1 - f, 0, 0 FROM n
        UNION ALL SELECT 2, 'UPDATE', 'predicate=o_totalprice < 100000; set o_orderstatus=''L''; set o_totalprice=o_totalprice + 1', v1, hit, hit, 0 FROM n
        UNION ALL SELECT 3, 'DELETE', 'predicate=o_totalprice > 300000', v1, 0, 0, v1 - v3 FROM n
        UNION ALL SELECT 4, 'MERGE', '', 0, again, 0, 0 FROM n)""",
)
def lake_operations(t):
    """The history with parameters and the rows each version read, wrote, updated and deleted."""
    given = F.array_sort(F.transform(F.map_entries("parameters"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return versioned_orders(t).history().select(
        "version",
        "operation",
        F.array_join(given, "; ").alias("parameters"),
        F.date_format("commit_ts", "yyyy-MM-dd").alias("day"),
        *("rows_read", "rows_written", "rows_updated", "rows_deleted"),
    )
