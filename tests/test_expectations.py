"""Known inputs with known results, through the library's own operators."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from weftline.functions import columns as C
from weftline.operators import aggregates as A
from weftline.operators import filters, ranking, sets
from weftline.plans.shaping import BEYOND_EDGES, DELAY_EDGES

# The inputs, as (the columns that matter), in their original order.
FLIGHTS = [
    ("01220625", 333, 602, "ABE", "ATL"), ("01220607", 219, 569, "ABE", "ORD"),
    ("02011325", 0, 1511, "PDX", "ORD"), ("02011535", 14, 1404, "PDX", "DFW"),
    ("01220955", -6, 349, "PIT", "MDW"), ("01221050", 0, 1576, "PIT", "PHX"),
    ("01221705", 30, 401, "PIT", "BNA"), ("03021810", -2, 1604, "SFO", "ORD"),
    ("03020925", 3, 1604, "SFO", "ORD"), ("03022330", 33, 1604, "SFO", "ORD"),
    ("03032330", 107, 1604, "SFO", "ORD"), ("02281405", 189, 1410, "STT", "JFK"),
    ("02281440", -5, 962, "STT", "MIA"), ("02280935", -10, 962, "STT", "MIA"),
    ("02281715", 263, 962, "STT", "MIA"), ("02011440", 12, 59, "STT", "SJU"),
]
DEPARTURES = [
    ("02190925", 10, 500, "SEA", "SFO"), ("02190926", -5, 600, "JFK", "LAX"), ("02190927", 20, 700, "ATL", "ORD"),
]
AIRPORTS = [("Seattle", "WA", "USA", "SEA"), ("San Francisco", "CA", "USA", "SFO"), ("New York", "NY", "USA", "JFK")]
CALLS = [
    ("Structure Fire", "01/11/2002", 1, 2.95), ("Medical Incident", "01/16/2002", 1, 4.7),
    ("Medical Incident", "01/21/2002", 1, 2.4333334),
]
CALLS_2018 = [
    ("Medical Incident", 22, 94124, "Bayview Hunters Point", 3.2333333),
    ("Medical Incident", 22, 94107, "Potrero Hill", 1.0),
    ("Alarms", 22, 94107, "South of Market", 2.95),
    ("Structure Fire", 24, 94112, "Excelsior", 1.2),
    ("Medical Incident", 25, 94122, "Inner Sunset", 1.45),
    ("Traffic Collision", 26, 94110, "Mission", 4.1666665),
    ("Medical Incident", 26, 94108, "Nob Hill", 6.866667),
    ("Structure Fire", 26, 94110, "Mission", 4.483333),
    ("Structure Fire", 29, 94124, "Bayview Hunters Point", 2.2333333),
    ("Odor (Strange / Unknown)", 29, 94112, "Excelsior", 4.6),
    ("Medical Incident", 29, 94103, "Mission", 3.3166666),
    ("Alarms", 29, 94123, "Marina", 2.7833333),
]
PERSONS = [
    (2303, "Doe", "Izod", "05/28/1981", "322160"), (4986, "Martainn", "Rouf", "05/26/1972", "253334"),
    (3381, "Betteann", "Croci", "06/12/1992", "264876"), (6142, "Derby", "Bettley", "09/21/1992", "148951"),
    (1234, "Dylan", "James", "03/15/1975", "90000"),
]
BLOGS = [
    (1, "John", "Doe", 5000), (2, "Jane", "Smith", 15000), (3, "Alice", "Brown", 2000), (4, "Bob", "White", 30000),
]
# Country, temperature, humidity, battery, CO2.
DEVICES = [
    ("United States", 29, 33, 0, 1520), ("United States", 26, 64, 7, 1360), ("Russia", 17, 87, 1, 1206),
    ("Republic of Korea", 31, 27, 9, 918), ("Japan", 18, 40, 3, 1007), ("United Kingdom", 30, 68, 1, 1193),
    ("Indonesia", 11, 95, 2, 1405), ("United States", 29, 27, 7, 860), ("United States", 16, 68, 0, 1133),
    ("Estonia", 26, 71, 5, 1069), ("Czech Republic", 27, 84, 2, 929), ("United States", 23, 76, 0, 804),
    ("Montenegro", 16, 84, 3, 875), ("China", 26, 82, 5, 1477),
]

FLIGHT = "date STRING, delay INT, distance INT, origin STRING, destination STRING"


@pytest.fixture(scope="module")
def flights(spark):
    return spark.createDataFrame(FLIGHTS, FLIGHT)


@pytest.fixture(scope="module")
def departures(spark):
    return spark.createDataFrame(DEPARTURES, FLIGHT)


@pytest.fixture(scope="module")
def calls_2018(spark):
    data = [(t, datetime.datetime(2018, 10, d), z, n, x) for t, d, z, n, x in CALLS_2018]
    return spark.createDataFrame(data, "type STRING, day TIMESTAMP, zip INT, place STRING, delay DOUBLE")


@pytest.fixture(scope="module")
def devices(spark):
    return spark.createDataFrame(DEVICES, "cn STRING, temp LONG, humidity LONG, battery LONG, co2 LONG")


def test_long_flights(flights):
    far = flights.filter("distance > 1000")
    assert far.count() == 8
    assert dict(far.groupBy("origin").count().collect()) == {"PDX": 2, "PIT": 1, "SFO": 4, "STT": 1}


def test_delay_classes(flights):
    label = C.bucketize(F.col("delay"), DELAY_EDGES, BEYOND_EDGES).alias("c")
    assert dict(flights.groupBy(label).count().collect()) == {
        "Long Delays": 4, "Short Delays": 1, "Tolerable Delays": 5, "No Delays": 2, "Early": 4,
    }


def test_union_and_join_of_a_route(spark, departures):
    route = departures.filter(
        (F.col("origin") == "SEA") & (F.col("destination") == "SFO") & F.col("date").startswith("021909") & (F.col("delay") > 0)
    )
    assert route.count() == 1 and sets.union_all([departures, route]).count() == 4
    airports = spark.createDataFrame(AIRPORTS, "City STRING, State STRING, Country STRING, IATA STRING")
    joined = route.join(airports, F.col("IATA") == F.col("origin"))
    assert rows(joined, "City", "State", "date", "delay", "distance", "destination") == [
        ("Seattle", "WA", "02190925", 10, 500, "SFO")
    ]


def test_ranked_totals(departures):
    totals = departures.filter(F.col("origin").isin("SEA", "SFO", "JFK")).groupBy("origin", "destination")
    ranked = ranking.top_values(totals.agg(F.sum("delay").alias("total")), ["origin"], "total", 3)
    assert rows(ranked) == [("JFK", "LAX", -5, 1), ("SEA", "SFO", 10, 1)]


def test_pivoted_months(departures):
    seattle = departures.filter("origin = 'SEA'").withColumn("month", F.substring("date", 1, 2).cast("int"))
    measures = {"AvgDelay": F.round(F.avg("delay"), 2), "MaxDelay": F.max("delay")}
    found = A.pivot_named(seattle, ["destination"], "month", {1: "JAN", 2: "FEB", 3: "MAR"}, measures).first()
    assert (found["FEB_AvgDelay"], found["FEB_MaxDelay"], found["JAN_AvgDelay"]) == (10.0, 10, None)


def test_calls_of_the_last_days(spark):
    calls = spark.createDataFrame(CALLS, "type STRING, date STRING, alarms INT, delay DOUBLE")
    calls = calls.withColumn("day", C.parse_time(F.col("date"), "MM/dd/yyyy"))
    assert filters.last_days(calls, "day", 7).count() == 2
    assert calls.groupBy("type").count().orderBy(F.col("count").desc()).first()[:] == ("Medical Incident", 2)
    total, mean, least, most = calls.agg(F.sum("alarms"), F.avg("delay"), F.min("delay"), F.max("delay")).first()
    assert (total, least, most) == (3, 2.4333334, 4.7) and mean == pytest.approx(3.3611111)


def test_days_come_first_in_the_other_pattern(spark):
    df = spark.createDataFrame([("01/01/2021",), ("02/01/2021",), ("03/01/2021",), ("2021",)], "d STRING")
    parsed = df.select(C.parse_time(F.col("d"), "dd/MM/yyyy").alias("d")).filter("d IS NOT NULL")
    assert rows(parsed) == [(datetime.datetime(2021, 1, d),) for d in (1, 2, 3)]


def test_questions_about_a_year(calls_2018):
    within = (F.col("day") >= "2018-01-01") & (F.col("day") < "2019-01-01")
    year = calls_2018.filter(within)
    assert year.select("type").distinct().count() == 5
    assert rows(year.groupBy(F.month("day")).count()) == [(10, 12)]
    assert rows(year.groupBy(F.weekofyear("day")).count()) == [(43, 8), (44, 4)]
    assert rows(year.groupBy("place").count().filter("count = 3")) == [("Mission", 3)]
    means = year.groupBy("place").agg(F.avg("delay").alias("m")).orderBy(F.col("m").desc()).collect()
    assert [m["place"] for m in means] == [
        "Nob Hill", "Mission", "South of Market", "Excelsior", "Marina", "Bayview Hunters Point", "Inner Sunset", "Potrero Hill",
    ]
    assert [m["m"] for m in means] == pytest.approx(
        [6.866667, 3.9888887, 2.95, 2.9, 2.7833333, 2.7333333, 1.45, 1.0], abs=1e-6
    )
    assert year.groupBy("place", "zip").count().count() == 9


def test_persons_by_four_conditions(spark):
    persons = spark.createDataFrame(PERSONS, "id INT, first STRING, last STRING, born STRING, salary STRING")
    older = C.year_of(C.parse_time(F.col("born"), "MM/dd/yyyy")) < 2025 - 40
    found = persons.filter(older & (F.col("salary").try_cast("int") > 80000)).filter(
        F.col("last").startswith("J") & F.col("first").startswith("D")
    )
    assert rows(found, "id") == [(1234,)]


def test_blogs(spark):
    blogs = spark.createDataFrame(BLOGS, "id INT, first STRING, last STRING, hits INT")
    assert rows(blogs, "id", F.col("hits") > 10000) == [(1, False), (2, True), (3, False), (4, True)]
    joined = blogs.select(F.concat("id", "first", "last"))
    assert rows(joined) == [("1JohnDoe",), ("2JaneSmith",), ("3AliceBrown",), ("4BobWhite",)]
    assert [r[0] for r in blogs.orderBy(F.col("id").desc()).select("id").collect()] == [4, 3, 2, 1]


def test_device_statistics(devices):
    assert devices.agg(F.max("battery")).first()[0] == 9
    assert filters.below_fraction_of_max(devices, "battery", 0.2).count() == 5
    assert set(rows(filters.above_quantile(devices, "co2", 0.75), "cn")) == {("United States",), ("Indonesia",), ("China",)}
    assert A.min_max(devices, ["temp", "battery", "co2", "humidity"]).first()[:] == (11, 31, 0, 9, 804, 1520, 27, 95)
    means = devices.groupBy("cn").agg(F.avg("temp"), F.avg("co2"), F.avg("humidity"))
    assert means.filter("cn = 'United States'").first()[1:] == (24.6, 1135.4, 53.6)


def test_counts_by_state_and_color(spark):
    pairs = [("CA", "Red"), ("CA", "Blue"), ("NY", "Green"), ("TX", "Red"), ("TX", "Yellow")]
    candies = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "State STRING, Color STRING, Count INT")
    counts = candies.groupBy("State", "Color").agg(F.count("Count").alias("Total"))
    assert {r["Total"] for r in counts.collect()} == {1} and counts.filter("State = 'CA'").count() == 2


def test_average_age(spark):
    ages = spark.createDataFrame([("Mark", 42), ("Neil", 38)], "name STRING, age INT")
    assert ages.agg(F.avg("age"), F.max("age")).first()[:] == (40.0, 42)
