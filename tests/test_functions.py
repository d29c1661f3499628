"""Golden values for column functions and dimensions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wheelhouse.functions import dates, geo, hashing, text, weather
from wheelhouse.plans import dimensions, words


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


def test_calendar_first_rows(spark):
    got = [tuple(r) for r in dimensions.calendar(spark).orderBy("date_sk").limit(4).collect()]
    day = dt.date(2009, 1, 1)
    assert got[0] == (0, 20090101, day, 2009, "January", 1, "Thursday", 5, 4, "Y", 1, "N", 1, 1, 1)
    assert [(r[1], r[6], r[7], r[8], r[9]) for r in got[1:]] == [
        (20090102, "Friday", 6, 5, "Y"),
        (20090103, "Saturday", 7, 6, "N"),
        (20090104, "Sunday", 1, 7, "N"),
    ]


def test_date_dimensions_have_all_days(spark):
    assert dimensions.calendar(spark).count() == 5478
    rides = dimensions.ride_dates(spark)
    assert rides.count() == 3653
    first = rides.orderBy("date_sk").first()
    assert (first.date_sk, first.date, first.is_weekday) == (1, dt.date(2015, 1, 1), True)


@pytest.mark.parametrize(
    ("condition", "celsius", "expected"),
    [("Rain", 30.0, 2), ("Snow", None, 2), ("Clear", 15.0, 3), ("Clear", 15.1, 1), ("Clear", None, 3), (None, 20.0, 3)],
)
def test_weather_id(spark, condition, celsius, expected):
    columns = F.lit(condition).cast("string"), F.lit(celsius).cast("double")
    assert one(spark, weather.weather_id(*columns)) == (expected,)


@pytest.mark.parametrize(
    ("condition", "kelvin", "expected"),
    [
        ("Snow", 260.0, "Neutral"),
        ("Clear", 288.15, "Neutral"),
        ("Clear", 288.16, "Pleasant"),
        ("Rain", 300.0, "Unpleasant"),
        ("light rain", 300.0, "Unpleasant"),
        (None, 300.0, "Neutral"),
    ],
)
def test_weather_type(spark, condition, kelvin, expected):
    assert one(spark, weather.weather_type(F.lit(condition).cast("string"), F.lit(kelvin))) == (expected,)


def test_weather_members(spark):
    got = [tuple(r) for r in dimensions.weather_members(spark).orderBy("weather_id").collect()]
    assert got == [(1, "Pleasant"), (2, "Unpleasant"), (3, "Neutral"), (4, "Unknown")]


def test_great_circle(spark):
    def km(*points):
        return one(spark, geo.great_circle_km(*(F.lit(p).cast("double") for p in points)))[0]

    assert km(51.2, 4.4, 51.2, 4.4) == 0.0
    assert km(51.2, 4.4, None, 4.4) is None
    assert km(0, 0, 0, 1) == pytest.approx(6371 * math.pi / 180)
    # So close that rounding lifts the cosine above 1 unless it is clamped.
    assert not math.isnan(km(51.2083, 4.44595, 51.2083, 4.445950000001))


def test_distance_falls_back(spark):
    def legs(*values):
        columns = [F.lit(v).cast("double") for v in values]
        return one(spark, geo.first_known_distance_km(tuple(columns[:4]), tuple(columns[4:])))[0]

    assert legs(0, 0, 0, 1, 5, 5, 5, 5) > 100
    assert legs(0, 0, 0, None, 0, 0, 0, 1) > 100
    assert legs(None, 0, 0, 1, 0, 0, 0, None) == 0.0


@pytest.mark.parametrize(
    ("written", "expected"),
    [("(51.2,4.4)", (51.2, 4.4)), ("51.2, -4.4", (51.2, -4.4)), ("POINT", None), ("(1,2", (1.0, 2.0)), (None, None)],
)
def test_parse_point(spark, written, expected):
    got = one(spark, geo.parse_point(F.lit(written).cast("string")))[0]
    assert (got and tuple(got)) == expected


def test_sql_function_for_distance(spark):
    geo.register_great_circle(spark, "gc_km")
    got = spark.sql("SELECT gc_km(0, 0, 0, 1), gc_km(1, 1, 1, 1), gc_km(1, NULL, 1, 1)").first()
    assert got[0] == pytest.approx(111.19, abs=0.01) and got[1] == 0 and got[2] is None


def test_elapsed(spark):
    start, end = ntz("2024-01-01 10:00:00"), ntz("2024-01-01 09:59:30.5")
    assert one(spark, dates.elapsed_seconds(start, end)) == (-29.5,)
    assert one(spark, dates.elapsed_hours(end, ntz("2024-01-01 11:59:30.5"))) == (2.0,)


def test_day_type_of_unknown_moment(spark):
    assert one(spark, dates.day_type(ntz(None)), dates.day_type(ntz("2024-01-06"))) == ("Weekday", "Weekend")


def test_shift_keeps_time_of_day(spark):
    assert one(spark, dates.shift_years(ntz("2020-02-29 13:14:15"), 4)) == (dt.datetime(2024, 2, 29, 13, 14, 15),)


def test_epoch_on_another_clock(spark):
    seconds = F.lit(1442872800)
    assert one(spark, dates.from_epoch(seconds), dates.from_epoch(seconds, "Europe/Brussels")) == (
        dt.datetime(2015, 9, 21, 22),
        dt.datetime(2015, 9, 22, 0),
    )


def test_hashes_and_nulls(spark):
    a, none = F.lit("a"), F.lit(None).cast("string")
    safe, same, plain = one(spark, hashing.row_hash(a, none), hashing.row_hash(a, F.lit("")), hashing.plain_hash(a, none))
    assert safe == same and plain is None
    # Without a separator different rows can share a hash; with one they do not.
    pairs = ((F.lit("ab"), F.lit("c")), (F.lit("a"), F.lit("bc")))
    assert len(set(one(spark, *(hashing.plain_hash(*p) for p in pairs)))) == 1
    assert len(set(one(spark, *(hashing.row_hash(*p) for p in pairs)))) == 2


def test_sql_literals(spark):
    got = one(
        spark,
        text.sql_text(F.lit("d'Artagnan")),
        text.sql_text(F.lit(None).cast("string")),
        text.sql_number(F.lit(None).cast("int")),
        text.sql_date(F.lit("2024-01-02").cast("date")),
        text.sql_timestamp(ntz("2024-01-02 03:04:05")),
        text.sql_point(F.lit(51), F.lit(4)),
    )
    assert got == (
        "'d''Artagnan'",
        "NULL",
        "NULL",
        "TO_DATE('2024-01-02','YYYY-MM-DD')",
        "TO_TIMESTAMP('2024-01-02 03:04:05','YYYY-MM-DD HH24:MI:SS')",
        "POINT(51,4)",
    )


def test_street_line(spark):
    street = F.lit("Main")
    numbers = [F.lit("5"), F.lit(""), F.lit(None).cast("string")]
    assert one(spark, *(text.street_line(street, n) for n in numbers)) == ("Main 5", "Main", "Main")


def test_weather_documents(spark, rows):
    docs = spark.createDataFrame(
        [
            ('{"zipCode":"2050","weather":[{"main":"Rain"}],"main":{"temp":283.39,"humidity":32},"dt":1569016801,"cod":200}',),
            ('{"zipCode":"2050","weather":[{"main":"Clear"}],"main":{"temp":299.0},"dt":1569016900}',),
            ('{"zipCode":"2060","weather":[],"main":{"temp":299.0},"dt":1569016900}',),
        ],
        "value string",
    )
    hour = dt.datetime(2019, 9, 20, 22)
    assert rows(dimensions.weather_hourly(docs)) == [("2050", hour, "Pleasant"), ("2060", hour, "Neutral")]
    assert dimensions.weather_hourly(docs, dedupe=False).count() == 3
    staged = {(r.postal_code, r.weather_condition): r.weather_id for r in dimensions.weather_staging(docs).collect()}
    assert staged == {("2050", "Rain"): 2, ("2050", "Clear"): 1, ("2060", None): 3}


def test_words(spark, rows):
    lines = spark.createDataFrame([("The cat  the",), ("",), ("Cat tail",), (None,)], "value string")
    assert rows(words.top_words(lines, "value", 2)) == [("cat", 2), ("the", 2)]
    counts = words.word_counts(lines, "value")
    assert rows(counts) == [("Cat", 1), ("The", 1), ("cat", 1), ("tail", 1), ("the", 1)]
    assert rows(words.letter_counts(counts)) == [("C", 1), ("T", 1), ("c", 1), ("t", 2)]
