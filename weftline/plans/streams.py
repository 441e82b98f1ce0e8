"""Structured Streaming jobs over the given tables, each run to the end of its input."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from weftline.functions.columns import bucketize, split_field, stable_number, words
from weftline.operators.joins import hot_keys
from weftline.plans.joining import (
    INTERVAL_SECONDS,
    INTERVAL_SQL,
    building,
    views_and_clicks,
)
from weftline.plans.registry import query
from weftline.plans.shaping import BEYOND_EDGES, DELAY_EDGES, count_numbers, sensor_lines
from weftline.schemas import EVENT_PAYLOAD
from weftline.session import scratch
from weftline.streaming import codecs, dedup, sinks, state, timers
from weftline.streaming.hot import join_as_it_comes
from weftline.streaming.joins import stream_equi_join, stream_interval_join
from weftline.streaming.progress import progress_table
from weftline.streaming.run import finish, run, run_all, run_until, start
from weftline.streaming.sources import replay, replay_batches, replay_together, table_stream, text_stream
from weftline.streaming.windows import (
    MERGE_SESSIONS_EARLY,
    LateCounter,
    as_event_time,
    session_windowed,
    windowed,
)

# Later than every event: moves the watermark past all open windows at the end of a replay.
FAR = datetime.datetime(2100, 1, 1)


def event_stream(t):
    """The events table as a stream, with an event time that can carry a watermark."""
    return as_event_time(table_stream(t.spark, t.path("events")), "ts")


def timed_events(t):
    return as_event_time(t.events, "ts")


def with_sentinel(df, time, **values):
    """The rows and one row at a far time, with the given values and else NULLs.

    A join key needs a value there: Spark drops rows with a NULL key before the watermark sees them.
    """
    fixed = {time: F.lit(FAR.isoformat(" ")), **{name: F.lit(v) for name, v in values.items()}}
    row = [fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]
    return df.unionByName(df.sparkSession.range(1).select(*row))


# ---- sources ----


@query("stream_file_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_file_count(t):
    counts = table_stream(t.spark, t.path("events"), max_files=1000).groupBy("event_type")
    return run(counts.agg(F.count("*").alias("n")), "update").latest(["event_type"])


@query("stream_rate", "SELECT event_id, event_type FROM events")
def stream_rate(t):
    rows = t.events.agg(F.max("event_id")).first()[0] + 1
    ticks = (
        t.spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows)
        .option("numPartitions", t.spark.sparkContext.defaultParallelism)
        .load()
    )
    events = t.events.select("event_id", "event_type")
    joined = ticks.join(events, F.col("value") == F.col("event_id")).select("event_id", "event_type")
    return run(joined).rows()


_LINES = "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(
    "stream_word_count",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM {_LINES})
    GROUP BY word""",
)
def stream_word_count(t):
    path = scratch(t.spark, "lines")
    t.documents.select("text").write.text(path)
    lines = text_stream(t.spark, path)
    counts = lines.select(F.explode(words(F.col("value"))).alias("word")).groupBy("word")
    return run(counts.agg(F.count("*").alias("n")), "update").latest(["word"])


@query(
    "stream_number_count",
    """SELECT CAST(word AS INTEGER) AS number, count(*) AS n FROM
    (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents)
    WHERE regexp_full_match(word, '[0-9]+') AND TRY_CAST(word AS INTEGER) IS NOT NULL GROUP BY ALL""",
)
def stream_number_count(t):
    documents = table_stream(t.spark, t.path("documents"))
    return run(count_numbers(documents, "text"), "update").latest(["number"])


@query("decode_json_value", "SELECT event_id, user_id, event_type, value FROM events")
def decode_json_value(t):
    encoded = codecs.encode_kv(t.events, "event_id", EVENT_PAYLOAD.names)
    return codecs.decode_json(encoded, EVENT_PAYLOAD)


@query(
    "encode_kv",
    """SELECT CAST(event_id AS VARCHAR) AS key,
        '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""",
)
def encode_kv(t):
    encoded = codecs.encode_kv(event_stream(t), "event_id", ["user_id", "event_type"])
    rows = run(encoded).rows()
    return rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


_HASH = "CAST('0x' || substr(md5(event_id || '|{seed}'), 1, 8) AS BIGINT)"


@query(
    "stream_sensor_gen",
    f"""SELECT event_id, CAST(event_id % 3 + 1 AS INTEGER) AS device_id,
        CAST(20 + {_HASH.format(seed=1)} % 61 AS INTEGER) AS temperature,
        CAST({_HASH.format(seed=2)} % 101 AS INTEGER) AS humidity, ts AS event_time FROM events""",
)
def stream_sensor_gen(t):
    tick = F.col("event_id")
    readings = event_stream(t).select(
        tick,
        (tick % 3 + 1).cast("int").alias("device_id"),
        (20 + stable_number(61, "event_id", 1)).cast("int").alias("temperature"),
        stable_number(101, "event_id", 2).cast("int").alias("humidity"),
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
    )
    return run(readings).rows()


# ---- sinks, modes, several queries ----


@query(
    "foreach_batch_multi",
    """SELECT place, event_type, count(*) AS n FROM events CROSS JOIN (VALUES ('first'), ('second')) v(place)
    GROUP BY ALL""",
)
def foreach_batch_multi(t):
    places = {name: scratch(t.spark, name) for name in ("first", "second")}
    counts = event_stream(t).groupBy("event_type").agg(F.count("*").alias("n"))
    writer = sinks.to_all([sinks.parquet_writer(path, files=1) for path in places.values()])
    finish(start(counts, "complete", "", scratch(t.spark, "checkpoint"), on_batch=writer))
    tables = []
    for name, path in places.items():
        batches = t.spark.read.parquet(path)
        newest = batches.agg(F.max("batch").alias("b")).scalar()
        last = batches.filter(F.col("batch") == newest)
        tables.append(last.select(F.lit(name).alias("place"), "event_type", "n"))
    return tables[0].unionByName(tables[1])


@query("foreach_batch_writer", "SELECT event_id, user_id, value FROM events")
def foreach_batch_writer(t):
    path = scratch(t.spark, "external")
    rows = event_stream(t).select("event_id", "user_id", "value")
    finish(start(rows, "append", "", scratch(t.spark, "checkpoint"), on_batch=sinks.parquet_writer(path)))
    return t.spark.read.parquet(path).drop("batch")


@query(
    "stream_triggers",
    """SELECT trigger, event_type, count(*) AS n FROM events
    CROSS JOIN (VALUES ('available now'), ('processing time')) v(trigger) GROUP BY ALL""",
)
def stream_triggers(t):
    """The same counts by a run over what is there, and by one that wakes at an interval until all rows are in."""
    rows, seen = t.events.count(), {}

    def all_in(report) -> bool:
        seen[report["batchId"]] = report["numInputRows"]
        return sum(seen.values()) >= rows

    counts = event_stream(t).groupBy("event_type").agg(F.count("*").alias("n"))
    results = {"available now": run(counts, "update"), "processing time": run_until(counts, all_in, every="1 second")}
    tables = [r.latest(["event_type"]).select(F.lit(k).alias("trigger"), "event_type", "n") for k, r in results.items()]
    return tables[0].unionByName(tables[1])


_BY_USER = "SELECT user_id, count(*) AS n FROM events GROUP BY user_id"


@query("stream_upsert", _BY_USER)
def stream_upsert(t):
    path = scratch(t.spark, "upserts")
    stream = replay(timed_events(t), "ts").stream()
    counts = stream.groupBy("user_id").agg(F.count("*").alias("n"))
    finish(start(counts, "update", "", scratch(t.spark, "checkpoint"), on_batch=sinks.upsert_writer(path)))
    return sinks.read_upserted(t.spark, path, counts.schema, ["user_id"])


@query("stream_and_batch_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def stream_and_batch_append(t):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]

    def stream(status):
        orders = table_stream(t.spark, t.path("orders"))
        return orders.filter(F.col("o_orderstatus") == status).select(*columns)

    streamed = run_all([("finished", stream("F"), "append"), ("opened", stream("O"), "append")])
    path = scratch(t.spark, "batch")
    t.orders.filter(F.col("o_orderstatus") == "P").select(*columns).write.mode("append").parquet(path)
    parts = [result.rows() for result in streamed.values()] + [t.spark.read.parquet(path)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_DAILY = """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
    event_type, count(*) AS n FROM events GROUP BY ALL"""


@query("mode_append", _DAILY)
def mode_append(t):
    events = with_sentinel(timed_events(t).select("ts", "event_type"), "ts")
    stream = replay(events, "ts").stream()
    daily = windowed(stream, "ts", "1 day", ["event_type"], watermark="1 hour")
    return run(daily, "append").rows().filter(F.col("event_type").isNotNull())


@query("mode_complete", _DAILY)
def mode_complete(t):
    return run(windowed(event_stream(t), "ts", "1 day", ["event_type"]), "complete").rows()


@query("mode_update", _DAILY)
def mode_update(t):
    stream = replay(timed_events(t), "ts").stream()
    daily = windowed(stream, "ts", "1 day", ["event_type"], watermark="1 hour")
    return run(daily, "update").latest(["window_start", "window_end", "event_type"]).select(*daily.columns)


@query(
    "multi_query",
    """SELECT 'types' AS query, event_type AS name, count(*) AS n FROM events GROUP BY ALL
    UNION ALL SELECT 'users', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY ALL""",
)
def multi_query(t):
    def counts(column):
        grouped = event_stream(t).groupBy(F.col(column).cast("string").alias("name"))
        return grouped.agg(F.count("*").alias("n"))

    results = run_all([("types", counts("event_type"), "update"), ("users", counts("user_id"), "update")])
    tables = [r.latest(["name"]).select(F.lit(name).alias("query"), "name", "n") for name, r in results.items()]
    return tables[0].unionByName(tables[1])


@query(
    "progress_table",
    "SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS dropped FROM events",
)
def progress(t):
    """In time order, every row is reported as read and none as late."""
    stream = replay(timed_events(t), "ts").stream()
    result = run(windowed(stream, "ts", "1 day", ["event_type"], watermark="1 hour"), "update")
    reports = progress_table(t.spark, result.progress)
    return reports.agg(
        F.sum("input_rows").alias("input_rows"), F.sum("rows_dropped_by_watermark").alias("dropped")
    )


# ---- stateless and aggregating ----


@query(
    "stream_stateless",
    """SELECT event_id, value * 20 AS scaled, CASE WHEN value > 40 THEN 'High' WHEN value > 20 THEN 'Medium' ELSE 'Low' END AS level,
        part FROM events CROSS JOIN (VALUES ('a'), ('b')) v(part) WHERE value > 10""",
)
def stream_stateless(t):
    level = bucketize(F.col("value"), [(20, "Low"), (40, "Medium")], "High")
    rows = event_stream(t).filter(F.col("value") > 10)
    rows = rows.withColumn("part", F.explode(F.array(F.lit("a"), F.lit("b"))))
    return run(rows.select("event_id", (F.col("value") * 20).alias("scaled"), level.alias("level"), "part")).rows()


@query("stream_running_count", "SELECT count(*) AS n FROM events")
def stream_running_count(t):
    return run(event_stream(t).groupBy().agg(F.count("*").alias("n")), "complete").rows()


@query("stream_count_by_key", _BY_USER)
def stream_count_by_key(t):
    stream = replay(timed_events(t), "ts").stream()
    return run(stream.groupBy("user_id").agg(F.count("*").alias("n")), "update").latest(["user_id"])


@query("stream_min_by_key", "SELECT user_id, min(value) AS smallest FROM events GROUP BY user_id")
def stream_min_by_key(t):
    return run(event_stream(t).groupBy("user_id").agg(F.min("value").alias("smallest")), "update").latest(["user_id"])


@query(
    "stream_tumbling",
    """SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end,
        user_id, count(*) AS n FROM events GROUP BY ALL""",
)
def stream_tumbling(t):
    return run(windowed(event_stream(t), "ts", "5 minutes", ["user_id"]), "update").latest(["window_start", "window_end", "user_id"])


@query(
    "stream_sliding",
    """SELECT window_start, window_start + INTERVAL 5 HOURS AS window_end, event_type, count(*) AS n FROM (
        SELECT event_type, ts, unnest([time_bucket(INTERVAL 3 HOURS, ts, TIMESTAMP '1970-01-01'),
            time_bucket(INTERVAL 3 HOURS, ts, TIMESTAMP '1970-01-01') - INTERVAL 3 HOURS]) AS window_start FROM events)
    WHERE ts < window_start + INTERVAL 5 HOURS GROUP BY ALL""",
)
def stream_sliding(t):
    # The slide does not divide the size: a row lies in one or two windows.
    counts = windowed(event_stream(t), "ts", "5 hours", ["event_type"], slide="3 hours")
    return run(counts, "update").latest(["window_start", "window_end", "event_type"])


@query(
    "stream_session",
    """WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events),
    s AS (SELECT *, sum(CASE WHEN ts - previous > INTERVAL 6 HOURS THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM e)
    SELECT min(ts) AS session_start, max(ts) + INTERVAL 6 HOURS AS session_end, user_id, count(*) AS n
    FROM s GROUP BY user_id, session""",
)
def stream_session(t):
    found = session_windowed(event_stream(t), "ts", "6 hours", ["user_id"])
    return run(found, "complete", conf=MERGE_SESSIONS_EARLY).rows()


@query(
    "stream_window_avg",
    """SELECT time_bucket(INTERVAL 2 HOURS, ts) AS window_start, time_bucket(INTERVAL 2 HOURS, ts) + INTERVAL 2 HOURS AS window_end,
        event_type, round(avg(value), 6) AS average FROM events GROUP BY ALL""",
)
def stream_window_avg(t):
    stream = replay(timed_events(t), "ts").stream()
    means = {"average": F.round(F.avg("value"), 6)}
    windows = windowed(stream, "ts", "2 hours", ["event_type"], means, watermark="10 minutes")
    return run(windows, "update").latest(["window_start", "window_end", "event_type"]).select(*windows.columns)


@query(
    "stream_parsed_window_sum",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
        CAST(sum(floor(value)) FILTER (event_type <> 'error') AS BIGINT) AS total FROM events GROUP BY ALL
    HAVING count(*) FILTER (event_type <> 'error') > 0""",
)
def stream_parsed_window_sum(t):
    path = scratch(t.spark, "lines")
    sensor_lines(t).select("line").write.text(path)
    line = F.col("value")
    parsed = text_stream(t.spark, path).select(
        split_field(line, "#", 1, "timestamp").alias("event_time"),
        split_field(line, "#", 2, "int").alias("reading"),
    )
    parsed = parsed.filter(F.col("event_time").isNotNull() & F.col("reading").isNotNull())
    sums = windowed(parsed, "event_time", "1 hour", aggregates={"total": F.sum("reading")})
    return run(sums, "update").latest(["window_start", "window_end"])


_LATE_CUTS = (0, 25, 50, 75)
_LATE_BATCH = "CASE WHEN value >= 75 THEN 3 WHEN value >= 50 THEN 2 WHEN value >= 25 THEN 1 ELSE 0 END"


def _late_bands(t):
    """Events in four bands of their value, which has nothing to do with their time."""
    events, value = timed_events(t), F.coalesce(F.col("value"), F.lit(float("-inf")))
    uppers = [*_LATE_CUTS[1:], float("inf")]
    lowers = [float("-inf"), *_LATE_CUTS[1:]]
    return [events.filter((value >= low) & ((value < high) | F.lit(high == float("inf")))) for low, high in zip(lowers, uppers, strict=True)]


@query(
    "stream_late_drop",
    f"""WITH e AS (SELECT {_LATE_BATCH} AS batch, ts, time_bucket(INTERVAL 2 HOURS, ts) + INTERVAL 2 HOURS AS closes FROM events),
    seen AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        - INTERVAL 2 MINUTES AS watermark FROM e GROUP BY batch)
    SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n, count(*) FILTER (closes <= watermark) AS late, any_value(watermark) AS watermark
    FROM e JOIN seen USING (batch) GROUP BY batch""",
)
def stream_late_drop(t):
    """Events in four given batches by value, so many come late: per batch how many, and behind which watermark."""
    stream = replay_batches(_late_bands(t)).stream()
    counter = LateCounter(t.spark, scratch(t.spark, "late"), "ts", "2 hours", "2 minutes")
    finish(start(stream, "append", "", scratch(t.spark, "checkpoint"), on_batch=counter.on_batch))
    return counter.report().withColumn("watermark", F.col("watermark").cast("timestamp_ntz"))


_WINDOW_COUNTS = """SELECT time_bucket(INTERVAL 2 HOURS, ts) AS window_start, time_bucket(INTERVAL 2 HOURS, ts) + INTERVAL 2 HOURS AS window_end,
    count(*) AS n FROM events GROUP BY ALL"""


@query("stream_late_complete", _WINDOW_COUNTS)
def stream_late_complete(t):
    """Complete mode lets no window go, so rows far behind the watermark still count."""
    counts = windowed(replay_batches(_late_bands(t)).stream(), "ts", "2 hours", watermark="2 minutes")
    return run(counts, "complete").rows()


@query("stream_within_delay", _WINDOW_COUNTS)
def stream_within_delay(t):
    """The watermark's guarantee: rows out of order, but by less than the delay, are all counted."""
    span = timed_events(t).agg((F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))).alias("s")).first()["s"] or 0
    counts = windowed(replay_batches(_late_bands(t)).stream(), "ts", "2 hours", watermark=f"{span + 1} seconds")
    return run(counts, "update").latest(["window_start", "window_end"])


# ---- deduplication ----


@query("stream_dedup", "SELECT event_id FROM events")
def stream_dedup(t):
    twice = event_stream(t).select(F.explode(F.array("event_id", "event_id")).alias("event_id"))
    return run(dedup.dedup(twice, ["event_id"])).rows()


@query("stream_dedup_wm", "SELECT event_id, ts FROM events UNION ALL SELECT event_id, ts + INTERVAL 1 MINUTE FROM events")
def stream_dedup_wm(t):
    """Each event three times, once of them a minute later: the exact copy goes, the later one stays."""
    times = F.array("ts", "ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    copies = timed_events(t).select("event_id", F.explode(times).alias("ts"))
    once = dedup.dedup_in_time(replay(copies, "ts").stream(), ["event_id"], "ts", "1 hour")
    return run(once).rows().withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ---- joins ----


def _with_customers(t, customers, how):
    orders, columns = table_stream(t.spark, t.path("orders")), ["o_orderkey", "o_custkey", "c_name"]
    joined = join_as_it_comes(orders, customers, "o_custkey", "c_custkey", ["o_orderkey"], columns, how)
    return joined.versions().select(*columns)


@query(
    "stream_static_join",
    "SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def stream_static_join(t):
    return _with_customers(t, t.customer, "inner")


@query(
    "stream_static_left",
    """SELECT o_orderkey, o_custkey, c_name FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey""",
)
def stream_static_left(t):
    return _with_customers(t, building(t), "left")


@query(
    "stream_stream_equi",
    "SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def stream_stream_equi(t):
    orders = table_stream(t.spark, t.path("orders")).select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table_stream(t.spark, t.path("customer")).select("c_custkey", "c_name")
    hot = hot_keys(t.orders, "o_custkey", 0.01)
    joined = stream_equi_join(orders, customers, "o_custkey", "c_custkey", ["o_orderkey"], hot)
    return run(joined.select("o_orderkey", "o_totalprice", "c_name")).rows()


def _interval(t, how):
    views, clicks = views_and_clicks(t)
    sides = [(with_sentinel(views, "view_time", viewer=-1), "view_time"), (with_sentinel(clicks, "click_time", clicker=-2), "click_time")]
    joined = stream_interval_join(
        *[side.stream() for side in replay_together(sides)],
        "viewer", "clicker", "view_time", "click_time",
        seconds=INTERVAL_SECONDS, watermark="10 minutes", how=how,
    )
    rows = run(joined.select("view_id", "viewer", "click_id")).rows()
    return rows.filter(F.col("view_id").isNotNull())


@query("stream_interval_inner", INTERVAL_SQL.format(how=""))
def stream_interval_inner(t):
    return _interval(t, "inner")


@query("stream_interval_left", INTERVAL_SQL.format(how="LEFT"))
def stream_interval_left(t):
    return _interval(t, "left")


@query(
    "stream_union",
    """SELECT event_type, count(*) AS n FROM (SELECT event_type FROM events
    UNION ALL SELECT event_type FROM events WHERE value > 50) GROUP BY event_type""",
)
def stream_union(t):
    both = event_stream(t).union(event_stream(t).filter(F.col("value") > 50))
    return run(both.groupBy("event_type").agg(F.count("*").alias("n")), "update").latest(["event_type"])


# ---- per-key state ----


def user_actions(df):
    """Clicks as moves, errors as idleness, other events unchanged."""
    kind = F.col("event_type")
    action = F.when(kind == "click", "move").when(kind == "error", "idle").otherwise(kind)
    return df.select("user_id", action.alias("action"), "event_id", "ts")


@query(
    "state_user_status",
    """SELECT user_id, coalesce(arg_max(event_type, event_id) FILTER (event_type IN ('click', 'error')) = 'click', false) AS active
    FROM events GROUP BY user_id""",
)
def state_user_status(t):
    stream = user_actions(event_stream(t))
    return run(state.last_status(stream, "user_id", "action", "event_id"), "update").latest(["user_id"])


@query(
    "state_event_timeout",
    """WITH e AS (SELECT * FROM events WHERE event_type IN ('click', 'error'))
    SELECT user_id, arg_max(event_type, ts) = 'click'
        AND max(ts) + INTERVAL 1 DAY >= (SELECT max(ts) - INTERVAL 10 MINUTE FROM e) AS active
    FROM e GROUP BY user_id""",
)
def state_event_timeout(t):
    """Users whose last change is a click are active, unless it lies a day behind the watermark at the end.

    Only changes are looked at, so it makes no difference which silences within the input are noticed.
    """
    changes = user_actions(timed_events(t)).filter(F.col("action").isin("move", "idle"))
    changes = changes.withColumn("place", F.unix_micros("ts"))
    status = state.track_status(
        replay(changes, "ts").stream(), "user_id", "action", "place",
        time="ts", watermark="10 minutes", event_timeout_ms=24 * 3_600_000,
    )
    return run(status, "update").latest(["user_id"])


@query(
    "state_alerts",
    """SELECT user_id, 'User is inactive' AS message FROM events GROUP BY user_id
    HAVING bool_or(event_type = 'error') OR coalesce(arg_min(event_type, event_id) <> 'click', true)""",
)
def state_alerts(t):
    """The set of alerts; it is the same however the input is cut."""
    stream = replay(user_actions(t.events), "event_id").stream()
    return run(state.track_status(stream, "user_id", "action", "event_id", alerts=True), "append").rows().distinct()


DAY_MS = 24 * 3_600_000


@query(
    "state_periodic",
    """WITH e AS (SELECT event_type, date_trunc('day', ts) + INTERVAL 1 DAY AS period_end, value FROM events),
    ends AS (SELECT event_type, period_end FROM e UNION SELECT event_type, period_end + INTERVAL 1 DAY FROM e),
    sums AS (SELECT ends.event_type, ends.period_end, count(e.event_type) AS n, coalesce(sum(e.value), 0) AS total FROM ends
        LEFT JOIN e ON e.event_type = ends.event_type AND e.period_end = ends.period_end GROUP BY ALL)
    SELECT event_type, CAST(period_end AS TIMESTAMP) AS period_end, n, round(total, 2) AS total,
        CAST(sum(n) OVER w AS BIGINT) AS n_so_far, round(sum(total) OVER w, 2) AS total_so_far
    FROM sums WINDOW w AS (PARTITION BY event_type ORDER BY period_end)""",
)
def state_periodic(t):
    """A daily task per kind of event: those of the day and all so far, until a day without any has gone by."""
    events = with_sentinel(timed_events(t), "ts")
    reports = timers.periodic_reports(
        replay(events, "ts").stream(), "event_type", "ts", "value", DAY_MS, "10 minutes", forget_ms=1000 * DAY_MS
    )
    rows = run(reports, conf=timers.TIMER_SETTINGS).rows().filter(F.col("event_type").isNotNull())
    return rows.select(
        "event_type",
        F.col("period_end").cast("timestamp_ntz").alias("period_end"),
        "n",
        F.round("total", 2).alias("total"),
        "n_so_far",
        F.round("total_so_far", 2).alias("total_so_far"),
    )


@query(
    "state_idle_timeout",
    """SELECT user_id, coalesce(arg_max(event_type, event_id) FILTER (event_type IN ('click', 'error')) = 'click', false)
    AS was_active, false AS active FROM events GROUP BY user_id""",
)
def state_idle_timeout(t):
    """Every user falls silent once the table has been read; runs until the last state is gone.

    The input is one micro-batch: processing time that passes between two would be silence as well.
    """
    kind = F.col("event_type")
    stream = table_stream(t.spark, t.path("events")).withColumn(
        "moves", F.when(kind == "click", True).when(kind == "error", False)
    )
    status = timers.idle_status(stream, "user_id", "moves", "event_id", idle_ms=1000)

    def all_gone(report) -> bool:
        return report["batchId"] > 0 and all(o["numRowsTotal"] == 0 for o in report["stateOperators"])

    return run_until(status, all_gone, conf=timers.TIMER_SETTINGS).latest(["user_id"])
