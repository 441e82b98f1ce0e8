"""Streams over replayed rows: late data, deduplication, joins, state, sinks, modes."""

import datetime
import random
import time
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.columns import words
from weftline.operators.joins import interval_join
from weftline.plans.streams import with_sentinel
from weftline.session import scratch
from weftline.streaming import codecs, dedup, sinks, state, timers
from weftline.streaming.joins import stream_equi_join, stream_interval_join, with_table
from weftline.streaming.progress import dropped_rows, progress_table
from weftline.streaming.run import finish, run, run_all, run_until, settings, start, state_partitions
from weftline.streaming.sources import replay, replay_batches, replay_together, table_stream, text_stream
from weftline.streaming.windows import LateCounter, session_windowed, windowed


def at(text):
    return datetime.datetime.fromisoformat(text)


def one_by_one(spark, data, schema):
    """A replay with one row per micro-batch."""
    return replay_batches([spark.createDataFrame([row], schema) for row in data])


# ---- windows and late data ----

SENSOR = "device_id INT, eventTime TIMESTAMP"


@pytest.fixture(scope="module")
def sensors(spark):
    """Three rows in time order, then eight from the day before."""
    times = ["2022-01-02 10:00", "2022-01-02 10:01", "2022-01-02 10:02"]
    times += [f"2022-01-01 09:{m:02d}" for m in range(4, 12)]
    return one_by_one(spark, [(i % 4 + 1, at(t)) for i, t in enumerate(times)], SENSOR)


@pytest.mark.parametrize("slide, dropped", [(None, 8), ("1 minute", 16)])
def test_late_rows_are_dropped_once_per_window(sensors, slide, dropped):
    counts = windowed(sensors.stream(), "eventTime", "2 minutes", ["device_id"], slide=slide, watermark="2 minutes")
    assert dropped_rows(run(counts, "update").progress) == dropped


@pytest.mark.parametrize("slide, dropped", [(None, 8), ("1 minute", 16)])
def test_late_rows_are_counted_before_they_are_combined(spark, sensors, slide, dropped):
    counter = LateCounter(spark, scratch(spark, "late"), "eventTime", "2 minutes", "2 minutes", slide)
    finish(start(sensors.stream(), "append", "", scratch(spark, "checkpoint"), on_batch=counter.on_batch))
    found = counter.report().orderBy("batch").collect()
    assert [r.n for r in found] == [1] * 11 and sum(r.late for r in found) == dropped
    assert found[0].watermark is None and found[-1].watermark == at("2022-01-02 10:00")


def test_equal_late_rows_of_one_task_all_count(spark):
    """Spark's own metric counts what it has combined; a repeated batch counts once."""
    parts = [[(1, at("2022-01-02 10:00"))], [(1, at("2022-01-01 09:00"))] * 5 + [(1, at("2022-01-02 10:01")), (2, None)]]
    frames = [spark.createDataFrame(p, SENSOR).coalesce(1) for p in parts]
    counter = LateCounter(spark, scratch(spark, "late"), "eventTime", "2 minutes", "2 minutes")
    for number, frame in [*enumerate(frames), (1, frames[1])]:
        counter.on_batch(frame, number)
    assert rows(counter.report().select("batch", "n", "late")) == [(0, 1, 0), (1, 7, 5)]
    counts = windowed(replay_batches(frames).stream(), "eventTime", "2 minutes", ["device_id"], watermark="2 minutes")
    assert dropped_rows(run(counts, "update").progress) < 5


def test_complete_mode_keeps_late_rows(sensors):
    counts = windowed(sensors.stream(), "eventTime", "2 minutes", ["device_id"], watermark="2 minutes")
    result = run(counts, "complete")
    assert dropped_rows(result.progress) == 0
    assert result.rows().agg(F.sum("n")).first()[0] == 11


def test_rows_within_the_delay_are_kept(spark):
    times = ["2022-01-02 10:10", "2022-01-02 10:05", "2022-01-02 10:01"]
    stream = one_by_one(spark, [(1, at(t)) for t in times], SENSOR).stream()
    result = run(windowed(stream, "eventTime", "1 minute", ["device_id"], watermark="10 minutes"), "update")
    assert dropped_rows(result.progress) == 0 and result.versions().count() == 3


@pytest.mark.parametrize("cut", [1, 4])
def test_windows_do_not_depend_on_the_batches(spark, cut):
    r = random.Random(1)
    data = [(r.randrange(4), datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=r.randrange(9000))) for _ in range(90)]
    batches = [spark.createDataFrame(data[i::cut], SENSOR) for i in range(cut)]
    whole = spark.createDataFrame(data, SENSOR)
    for build in (
        lambda d: windowed(d, "eventTime", "5 minutes", ["device_id"]),
        lambda d: windowed(d, "eventTime", "5 minutes", ["device_id"], slide="3 minutes"),
        lambda d: session_windowed(d, "eventTime", "4 minutes", ["device_id"]),
        lambda d: d.groupBy("device_id").agg(F.count("*").alias("n")),
    ):
        assert rows(run(build(replay_batches(batches).stream()), "complete").rows()) == rows(build(whole))


def test_append_mode_holds_open_windows_back(spark):
    data = [(1, at("2024-01-01 10:00")), (1, at("2024-01-01 10:30")), (1, at("2024-01-01 11:00"))]
    stream = one_by_one(spark, data, SENSOR).stream()
    result = run(windowed(stream, "eventTime", "10 minutes", watermark="5 minutes"), "append")
    assert result.rows().count() == 2


def test_update_mode_versions_and_latest(spark):
    stream = replay_batches([spark.createDataFrame([(k,) for k in part], "k STRING") for part in ("ab", "a", "c")]).stream()
    result = run(stream.groupBy("k").agg(F.count("*").alias("n")), "update")
    assert rows(result.versions(), "k", "n") == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert rows(result.latest(["k"])) == [("a", 2), ("b", 1), ("c", 1)]
    with pytest.raises(ValueError, match="latest"):
        result.rows()


def test_impossible_modes_are_rejected(spark):
    stream = replay_batches([spark.range(2)]).stream()
    with pytest.raises(Exception, match="omplete"):
        run(stream, "complete")
    with pytest.raises(Exception, match="watermark"):
        run(stream.groupBy("id").count(), "append")
    with pytest.raises(ValueError, match="mode must be one of"):
        run(stream, "replace")


# ---- sources ----


@pytest.mark.parametrize("slices", [3, 6])
def test_replay_keeps_all_rows_in_order(spark, slices):
    df = spark.range(100).select(F.when(F.col("id") < 4, None).otherwise(F.col("id") % 50).alias("o"), "id")
    made = replay(df, "o", slices=slices, rows_per_file=10)
    result = run(made.stream().groupBy("id", "o").count(), "update")
    versions = result.versions().toPandas()
    assert len(versions) == 100
    spans = versions[versions.o.notna()].groupby("batch").o.agg(["min", "max"])
    assert len(spans) == slices and (spans["min"].iloc[1:].values > spans["max"].iloc[:-1].values).all()


def test_replay_grows_its_slices_with_the_table(spark):
    assert replay(spark.range(100), "id", slices=1, rows_per_slice=20).slices == 5


def test_replay_together_cuts_both_sides_at_the_same_values(spark):
    """The second table has no rows in some spans: its micro-batches there are empty, not later ones."""
    wide = spark.range(90).select(F.col("id").alias("a"))
    gap = spark.range(90).filter("id < 5 or id >= 85").select(F.col("id").alias("b"), F.lit("x").alias("more"))
    left, right = replay_together([(wide, "a"), (gap, "b")], slices=4, rows_per_file=5)
    assert left.slices == right.slices and left.files_per_slice > 1
    both = left.stream().select(F.lit("a").alias("side"), F.col("a").alias("v"))
    both = both.unionByName(right.stream().select(F.lit("b").alias("side"), F.col("b").alias("v")))
    seen = run(both.groupBy("side", "v").count(), "update").versions().toPandas()
    assert len(seen) == 100 and set(seen["count"]) == {1}
    spans = seen.groupby("batch").v.agg(["min", "max"])
    assert len(spans) == 4 and (spans["min"].iloc[1:].values > spans["max"].iloc[:-1].values).all()


def test_replay_of_nothing(spark):
    empty = spark.range(0)
    assert run(replay(empty, "id").stream()).rows().count() == 0
    left, right = replay_together([(spark.range(3), "id"), (empty, "id")])
    assert run(right.stream()).rows().count() == 0 and run(left.stream()).rows().count() == 3


def test_table_stream_reads_a_file_or_a_folder(spark):
    path = scratch(spark, "table.parquet")
    spark.range(10).repartition(3).write.parquet(path)
    result = run(table_stream(spark, path, max_files=1))
    assert result.rows().count() == 10 and len([p for p in result.progress if p["numInputRows"]]) == 3
    name = "/root/testdata/sf0.001/events.parquet"
    assert run(table_stream(spark, name)).rows().count() == spark.read.parquet(name).count()


def test_word_count_over_lines(spark):
    path = scratch(spark, "lines")
    spark.createDataFrame([("hello world",), ("hello Spark",)], "value STRING").write.text(path)
    counts = text_stream(spark, path).select(F.explode(words(F.col("value"))).alias("w")).groupBy("w").count()
    assert rows(run(counts, "complete").rows()) == [("Spark", 1), ("hello", 2), ("world", 1)]


def test_records_of_a_broker(spark):
    df = spark.createDataFrame([(1, "x", 2.5), (2, None, None)], "id INT, name STRING, v DOUBLE")
    encoded = codecs.encode_kv(df, "id", ["id", "name", "v"])
    assert encoded.dtypes == [("key", "binary"), ("value", "binary")]
    assert rows(codecs.decode_json(encoded, df.schema)) == rows(df)
    broken = spark.createDataFrame([("{oops",)], "value STRING")
    assert rows(codecs.decode_json(broken, df.schema)) == [(None, None, None)]
    text = codecs.encode_text(df, "name", F.concat("name", F.lit(":"), "v"))
    assert bytes(text.first()["value"]) == b"x:2.5"


# ---- deduplication ----

GUID = "guid STRING, eventTime TIMESTAMP, data STRING"


@pytest.fixture(scope="module")
def guids(spark):
    """Ten rows: an exact copy, ids that return later, and two rows that come far too late."""
    data = [
        ("g1", at("2023-06-09 12:00"), "d1"),
        ("g2", at("2023-06-09 12:05"), "d2"),
        ("g3", at("2023-06-09 12:20"), "d3"),
        ("g1", at("2023-06-09 12:00"), "copy"),
        ("g4", at("2023-06-09 12:45"), "d4"),
        ("g5", at("2023-06-09 13:30"), "d5"),
        ("g3", at("2023-06-09 13:31"), "later"),
        ("g6", at("2023-06-09 15:00"), "d6"),
        ("g2", at("2023-06-09 12:06"), "late"),
        ("g1", at("2023-06-09 12:07"), "late"),
    ]
    return one_by_one(spark, data, GUID)


def test_dedup_in_time(guids):
    result = run(dedup.dedup_in_time(guids.stream(), ["guid"], "eventTime", "1 hour"))
    assert rows(result.rows(), "data") == [("d1",), ("d2",), ("d3",), ("d4",), ("d5",), ("d6",), ("later",)]
    assert dropped_rows(result.progress) == 2


def test_dedup_by_id(guids):
    found = run(dedup.dedup(guids.stream().select("guid"), ["guid"])).rows()
    assert rows(found) == [(f"g{i}",) for i in range(1, 7)]


def test_dedup_within_the_delay(guids):
    result = run(dedup.dedup_within(guids.stream(), ["guid"], "eventTime", "3 hours"))
    assert rows(result.rows(), "data") == [("d1",), ("d2",), ("d3",), ("d4",), ("d5",), ("d6",)]


# ---- joins ----

IMPRESSION, CLICK = "ad STRING, shown TIMESTAMP", "clicked STRING, at TIMESTAMP"


@pytest.fixture(scope="module")
def ads(spark):
    impressions = [
        ("a", at("2024-07-09 12:31:56")), ("b", at("2024-07-09 12:34:55")), ("c", at("2024-07-09 12:42:52")),
        ("d", at("2024-07-09 12:45:49")), ("e", at("2024-07-09 12:45:57")), ("f", at("2024-07-09 13:48:57")),
    ]
    clicks = [
        ("a", at("2024-07-09 12:35:56")), ("x", at("2024-07-09 12:38:53")), ("c", at("2024-07-09 12:40:52")),
        ("e", at("2024-07-09 12:53:48")), ("y", at("2024-07-09 12:59:47")), ("z", at("2024-07-09 13:44:50")),
    ]
    return one_by_one(spark, impressions, IMPRESSION), one_by_one(spark, clicks, CLICK)


def joined(ads, how):
    left, right = ads
    stream = stream_interval_join(left.stream(), right.stream(), "ad", "clicked", "shown", "at", 900, "10 minutes", how)
    return run(stream.select("ad", "clicked")).rows()


def test_interval_join_of_streams(ads):
    assert rows(joined(ads, "inner")) == [("a", "a"), ("e", "e")]


def test_outer_interval_join_emits_when_no_partner_can_come(ads):
    # c was clicked before it was shown; f is still waiting at the end.
    assert rows(joined(ads, "left")) == [("a", "a"), ("b", None), ("c", None), ("d", None), ("e", "e")]


def test_interval_join_of_streams_equals_batch(spark):
    r = random.Random(8)
    base = datetime.datetime(2024, 1, 1)
    make = lambda n: [(r.choice("hhab"), base + datetime.timedelta(seconds=r.randrange(6000))) for _ in range(n)]
    a, b = spark.createDataFrame(make(60), IMPRESSION), spark.createDataFrame(make(60), CLICK)
    batch = interval_join(a, b, "ad", "clicked", "shown", "at", 300, "left")
    stream = stream_interval_join(
        replay(with_sentinel(a, "shown", ad="-"), "shown").stream(),
        replay(with_sentinel(b, "at", clicked="+"), "at").stream(),
        "ad", "clicked", "shown", "at", 300, "1 minute", "left",
    )
    assert rows(run(stream).rows().filter("ad <> '-'")) == rows(batch)


def test_stream_with_table(spark):
    clicks = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("n", 4)], "ad STRING, id INT")
    table = spark.createDataFrame([("a", "x"), ("b", "y")], "key STRING, v STRING")
    for hot in ([], ["a"]):
        stream = replay_batches([clicks]).stream()
        inner = run(with_table(stream, table, "ad", "key", ["id"], hot).select("id", "v")).rows()
        assert rows(inner) == [(1, "x"), (2, "x"), (3, "y")]
        left = run(with_table(stream, table, "ad", "key", ["id"], hot, "left").select("id", "v")).rows()
        assert rows(left) == [(1, "x"), (2, "x"), (3, "y"), (4, None)]
    with pytest.raises(ValueError, match="only inner and left"):
        with_table(stream, table, "ad", "key", ["id"], how="right")


def test_equi_join_of_streams_with_a_hot_key(spark):
    facts = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(30)], "id INT, k INT")
    unique = spark.createDataFrame([(k, f"n{k}") for k in range(10)], "u INT, n STRING")
    with pytest.warns(UserWarning, match="keeps all rows"):
        stream = stream_equi_join(
            replay(facts, "id").stream(), replay(unique, "u").stream(), "k", "u", ["id"], [1]
        )
    assert rows(run(stream).rows()) == rows(facts.join(unique, facts.k == unique.u))


# ---- state ----

ACTION = "userId STRING, action STRING, n INT"


def actions(spark, batches):
    n, frames = 0, []
    for batch in batches:
        data = [(u, a, n + i) for i, (u, a) in enumerate(batch)]
        n += len(batch)
        frames.append(spark.createDataFrame(data, ACTION))
    return replay_batches(frames).stream()


@pytest.mark.parametrize("build", [state.track_status, state.last_status])
def test_last_status_per_user(spark, build):
    data = [[("1", "move")], [("2", "idle"), ("3", "move")], [("1", "idle"), ("2", "move"), ("3", "move")]]
    result = run(build(actions(spark, data), "userId", "action", "n"), "update")
    assert rows(result.latest(["userId"])) == [("1", False), ("2", True), ("3", True)]
    # One output per key and batch.
    assert result.versions().count() == 6


@pytest.mark.parametrize("build", [state.track_status, state.last_status])
def test_status_follows_the_order_not_the_arrival(spark, build):
    rows_out_of_order = [("1", "idle", 5), ("1", "move", 3), ("1", "look", 9), ("2", "look", 1), (None, "move", 1)]
    frames = [spark.createDataFrame([r], ACTION) for r in rows_out_of_order]
    result = run(build(replay_batches(frames).stream(), "userId", "action", "n"), "update")
    assert rows(result.latest(["userId"])) == [("1", False), ("2", False), (None, True)]


def test_alerts_for_users_left_inactive(spark):
    move, idle = "move", "idle"
    data = [
        [("1", move), ("2", move), ("3", move)],
        [("1", idle), ("4", move), ("3", move)],
        [("1", move), ("5", move)],
        [("2", idle), ("3", idle), ("4", idle), ("5", idle)],
    ]
    result = run(state.track_status(actions(spark, data), "userId", "action", "n", alerts=True), "append")
    assert rows(result.rows()) == [(str(u), "User is inactive") for u in range(1, 6)]


@pytest.mark.parametrize("cut", [1, 2, 3, 6])
def test_alerts_do_not_depend_on_the_cut(spark, cut):
    data = [("1", "idle"), ("2", "move"), ("1", "move"), ("3", "look"), ("2", "look"), ("1", "move")]
    batches = [data[i : i + cut] for i in range(0, len(data), cut)]
    result = run(state.track_status(actions(spark, batches), "userId", "action", "n", alerts=True), "append")
    assert rows(result.rows().distinct()) == [("1", "User is inactive"), ("3", "User is inactive")]


def timed(spark):
    minutes = [("1", 0), ("2", 5), ("3", 20), ("1", 35), ("4", 45), ("3", 50), ("1", 70), ("3", 80), ("4", 90), ("5", 150)]
    start_time = datetime.datetime(2023, 6, 9, 12)
    data = [(u, "idle" if m == 35 else "move", m, start_time + datetime.timedelta(minutes=m)) for u, m in minutes]
    return data, ACTION + ", at TIMESTAMP"


def statuses(spark, data, schema):
    stream = one_by_one(spark, data, schema).stream()
    tracked = state.track_status(
        stream, "userId", "action", "n", time="at", watermark="10 minutes", event_timeout_ms=3_600_000
    )
    return rows(run(tracked, "update").latest(["userId"]))


def test_silent_users_time_out_in_event_time(spark):
    data, schema = timed(spark)
    # At the end the watermark is 14:20: an hour after the last event of 2, not yet of 4 (13:30).
    assert statuses(spark, data, schema) == [("1", False), ("2", False), ("3", True), ("4", True), ("5", True)]
    last = ("6", "idle", 999, datetime.datetime(2100, 1, 1))
    assert statuses(spark, [*data, last], schema) == [(str(u), False) for u in range(1, 7)]


def test_event_timeout_needs_a_watermark(spark):
    with pytest.raises(ValueError, match="needs time and watermark"):
        state.track_status(actions(spark, [[("1", "move")]]), "userId", "action", "n", event_timeout_ms=1)


def test_silent_users_time_out_in_processing_time(spark):
    stream = actions(spark, [[("1", "move")]])
    tracked = state.track_status(stream, "userId", "action", "n", idle_ms=1000)
    path = scratch(spark, "idle")
    query = start(tracked, "update", path, scratch(spark, "checkpoint"), every="1 second")
    try:
        found = []
        for _ in range(40):
            time.sleep(1)
            if len([p for p in query.recentProgress if p["batchId"] >= 1]) and query.isActive:
                found = rows(spark.read.parquet(path), "userId", "active")
                if ("1", False) in found:
                    break
        assert found == [("1", False), ("1", True)]
    finally:
        query.stop()


# ---- hot keys ----


def test_frequent_keys_are_not_missed(spark):
    """Whatever the batches, a key above the share is found, counts are bounded, and a repeated batch counts once."""
    from weftline.streaming.hot import FrequentKeys

    r = random.Random(8)
    keys = FrequentKeys(spark, scratch(spark, "keys"), T.LongType(), 0.2)
    seen = []
    for number in range(5):
        batch = [r.choice([1, 1, 2, None, *range(100, 160)]) if number else r.randrange(1000) for _ in range(300)] + [1] * 60 * number
        df = spark.createDataFrame([(k,) for k in batch], "k LONG")
        for _ in range(2 if number == 3 else 1):
            keys.add(df, "k", number)
        seen += batch
        counts, lost, total = keys._at(number)
        true = {k: seen.count(k) for k in set(seen) - {None}}
        assert total == len(seen) and len(counts) <= 20 and lost <= len(seen) / 20 * 2
        assert all(true[k] - lost <= n <= true[k] for k, n in counts.items())
        assert {k for k, n in true.items() if n > 0.2 * len(seen)} <= set(keys.hot(number))
    assert 1 in keys.hot(4)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_of_a_stream_are_spread_as_they_come(spark, how, monkeypatch):
    """A key with a third of the rows; nothing is known before, and no key is joined in one task."""
    from weftline.streaming import hot

    named = []
    monkeypatch.setattr(hot, "with_table", lambda *a: named.append(a[5]) or with_table(*a))
    data = [(i, 7 if i % 3 == 0 else i % 50, "x") for i in range(300)] + [(300, None, "y"), (301, 999, "z")]
    parts = [spark.createDataFrame(data[i::2], "id LONG, ad LONG, a STRING") for i in range(2)]
    table = spark.createDataFrame([(k, f"v{k}") for k in range(50)], "key LONG, v STRING")
    found = hot.join_as_it_comes(replay_batches(parts).stream(), table, "ad", "key", ["id"], ["id", "v"], how, 0.1)
    plain = spark.createDataFrame(data, "id LONG, ad LONG, a STRING").join(table, F.col("ad") == F.col("key"), how)
    assert rows(found.versions().select("id", "v")) == rows(plain.select("id", "v"))
    assert named[0] == () and named[1:] == [[7], [7]]


# ---- timers ----


def reports_by_definition(data, minutes, after):
    """Per key and period end: rows and sum in the period, and up to its end."""
    step, epoch = datetime.timedelta(minutes=minutes), datetime.datetime(1970, 1, 1)
    sums, ends = {}, set()
    for key, when, value in data:
        end = epoch + ((when - epoch) // step + 1) * step
        n, total = sums.get((key, end), (0, 0.0))
        sums[key, end] = n + 1, total + (value or 0.0)
        ends |= {(key, end + k * step) for k in range(after + 1)}
    out = []
    for key, end in ends:
        upto = [v for (k, e), v in sums.items() if k == key and e <= end]
        out.append((key, end, *sums.get((key, end), (0, 0.0)), sum(n for n, _ in upto), sum(x for _, x in upto)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cut, after", [(1, 0), (3, 2), (12, 1)])
def test_periodic_reports_do_not_depend_on_the_cut(spark, cut, after):
    """Also with one row per batch, a key that holds most rows, gaps, and null keys and values."""
    start_of = datetime.datetime(2024, 1, 1)
    r = random.Random(3)
    data = [(r.choice([1, 1, 1, 2, None]), start_of + datetime.timedelta(minutes=r.randrange(600)), r.choice([1.0, 2.5, None])) for _ in range(12)]
    data.sort(key=lambda row: row[1])
    schema = "k LONG, t TIMESTAMP, v DOUBLE"
    size = -(-len(data) // cut)
    parts = [data[i : i + size] for i in range(0, len(data), size)] + [[(9, datetime.datetime(2100, 1, 1), None)]]
    stream = replay_batches([spark.createDataFrame(p, schema) for p in parts]).stream()
    made = timers.periodic_reports(stream, "k", "t", "v", 3_600_000, "10 minutes", after=after)
    found = run(made, conf=timers.TIMER_SETTINGS).rows()
    assert rows(found.filter("k IS NULL OR k < 9")) == reports_by_definition(data, 60, after)


def test_forgotten_sums_start_anew(spark):
    start_of = datetime.datetime(2024, 1, 1)
    data = [(1, 0, 1.0), (1, 5, 2.0), (1, 30, 4.0), (9, 24 * 365, None)]
    parts = [[(k, start_of + datetime.timedelta(hours=h), v)] for k, h, v in data]
    stream = replay_batches([spark.createDataFrame(p, "k LONG, t TIMESTAMP, v DOUBLE") for p in parts]).stream()
    made = timers.periodic_reports(stream, "k", "t", "v", 3_600_000, "1 minute", after=0, forget_ms=10 * 3_600_000)
    found = run(made, conf=timers.TIMER_SETTINGS).rows().filter("k = 1").select("n", "n_so_far", "total_so_far")
    assert rows(found) == [(1, 1, 1.0), (1, 1, 4.0), (1, 2, 3.0)]


def test_silence_is_reported_once_and_forgotten(spark):
    stream = replay_batches([spark.createDataFrame([("a", True, 1), ("a", None, 2), ("b", True, 2), ("b", False, 3), (None, True, 1)], "k STRING, up BOOLEAN, n LONG")]).stream()
    made = timers.idle_status(stream, "k", "up", "n", 500)
    result = run_until(made, lambda p: p["batchId"] > 0 and p["stateOperators"][0]["numRowsTotal"] == 0, conf=timers.TIMER_SETTINGS)
    first = [("a", True, True), ("b", False, False), (None, True, True)]
    later = [("a", True, False), ("b", False, False), (None, True, False)]
    assert rows(result.versions(), "k", "was_active", "active") == sorted(first + later, key=repr)
    assert rows(result.latest(["k"])) == sorted(later, key=repr)


def test_a_condition_that_never_comes_ends_in_a_time_out(spark):
    stream = replay_batches([spark.range(2)]).stream()
    with pytest.raises(TimeoutError):
        run_until(stream, lambda p: False, "append", timeout=3)
    assert not spark.streams.active


# ---- sinks ----


def test_batches_go_to_several_places_and_empty_ones_nowhere(spark):
    paths = [scratch(spark, "one"), scratch(spark, "two")]
    frames = [spark.createDataFrame([(w,) for w in part], "w STRING") for part in (["test"] * 3, [])]
    counts = replay_batches(frames).stream().groupBy("w").agg(F.count("*").alias("n"))
    writer = sinks.to_all([sinks.parquet_writer(paths[0], files=1), sinks.parquet_writer(paths[1])])
    finish(start(counts, "update", "", scratch(spark, "checkpoint"), on_batch=writer))
    for path in paths:
        assert rows(spark.read.parquet(path)) == [("test", 3, 0)]


def test_upserts_and_repeated_batches(spark):
    path = scratch(spark, "upserts")
    write = sinks.upsert_writer(path)
    schema = spark.createDataFrame([], "k STRING, n INT").schema
    write(spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    write(spark.createDataFrame([("a", 2)], schema), 1)
    write(spark.createDataFrame([("a", 2)], schema), 1)
    assert rows(sinks.read_upserted(spark, path, schema, ["k"])) == [("a", 2), ("b", 1)]
    assert rows(sinks.read_upserted(spark, path, schema, ["k"], version=0)) == [("a", 1), ("b", 1)]


def test_a_restarted_query_goes_on_where_it_stopped(spark):
    path, checkpoint, source = (scratch(spark, n) for n in ("out", "checkpoint", "in"))
    for part in ([1, 2], [3]):
        spark.createDataFrame([(x,) for x in part], "x INT").write.mode("append").parquet(source)
        finish(start(table_stream(spark, source), "append", path, checkpoint))
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (3,)]


def test_one_failing_query_stops_the_others(spark):
    good = replay_batches([spark.range(3)]).stream()
    bad = replay_batches([spark.range(3)]).stream().select(F.raise_error("broken").cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        run_all([("bad", bad, "append"), ("good", good, "append")])
    assert not spark.streams.active


def test_settings_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), settings(spark, {name: "77", "spark.weftline.x": "1"}):
        assert spark.conf.get(name) == "77"
        raise RuntimeError
    assert spark.conf.get(name) == before and spark.conf.get("spark.weftline.x", None) is None


def test_progress_as_a_table(spark, sensors):
    counts = windowed(sensors.stream(), "eventTime", "2 minutes", ["device_id"], watermark="2 minutes")
    table = progress_table(spark, run(counts, "update").progress)
    totals = table.agg(F.sum("input_rows"), F.sum("rows_dropped_by_watermark")).first()
    assert tuple(totals) == (11, 8)


@pytest.mark.parametrize("wanted", ["12", "200", "16384"])
def test_state_metrics_sent_to_the_driver_are_bounded(wanted):
    """Every state task of a batch sends about 175 bytes per partition and store, and a join of streams has four stores."""
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077"), conf={"spark.sql.shuffle.partitions": wanted})
    number = int(state_partitions(cluster)["spark.sql.shuffle.partitions"])
    assert number >= 32 and 175 * number**2 * 4 <= 20e6
