"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.catalog.bindings import REP_RUN, Tables, with_tables
from wheelhouse.catalog.registry import query
from wheelhouse.functions import dates, geo, hashing, text, weather
from wheelhouse.operators import limits
from wheelhouse.sources import files

AS_OF = "1998-12-31 00:00:00"


# --- projections ---------------------------------------------------------------------------------


@query(
    "project_rename",
    "SELECT p_partkey AS vehicle_id, p_name AS serial_number, p_type AS type FROM part",
)
def project_rename(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("vehicle_id"), F.col("p_name").alias("serial_number"), F.col("p_type").alias("type")
    )


@query(
    "project_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_text, CAST(o_custkey AS INT) AS customer_int,
        CAST(o_orderdate AS DATE) AS order_day, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount_text
        FROM orders""",
)
def project_cast(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_text"),
        F.col("o_custkey").cast("int").alias("customer_int"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        hashing.money(F.col("o_totalprice")).cast("string").alias("amount_text"),
    )


@query(
    "project_nested_field",
    with_tables("weather", "SELECT event_id, zipcode, 51.2::DOUBLE AS lat, condition FROM weather"),
)
def project_nested_field(t: Tables) -> DataFrame:
    doc = files.parse_json(F.col("value"), files.WEATHER_SCHEMA)
    return t.weather_documents.select("event_id", doc.alias("doc")).select(
        "event_id",
        F.col("doc.zipCode").alias("zipcode"),
        F.col("doc.coord.lat").alias("lat"),
        F.get(F.col("doc.weather"), F.lit(0))["main"].alias("condition"),
    )


@query(
    "project_constant",
    """SELECT c_custkey, TIMESTAMP '2100-12-12 00:00:00' AS scd_end, TRUE AS is_current, 1 AS count_mv FROM customer""",
)
def project_constant(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.lit("2100-12-12 00:00:00").cast("timestamp_ntz").alias("scd_end"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("count_mv"),
    )


@query(
    "project_star_plus",
    "SELECT *, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders",
)
def project_star_plus(t: Tables) -> DataFrame:
    return t.orders.select("*", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query("rename_aggregate", "SELECT event_type, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def rename_aggregate(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"))


# --- filters -------------------------------------------------------------------------------------


@query(
    "filter_compare",
    """SELECT l_orderkey, l_partkey, l_quantity, l_discount FROM lineitem
        WHERE (l_quantity >= 45 AND l_discount < 0.03) OR l_returnflag = 'R' AND l_tax > 0.07""",
)
def filter_compare(t: Tables) -> DataFrame:
    large = (F.col("l_quantity") >= 45) & (F.col("l_discount") < 0.03)
    returned = (F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.07)
    return t.lineitem.where(large | returned).select("l_orderkey", "l_partkey", "l_quantity", "l_discount")


@query(
    "filter_not_null",
    with_tables("rides", "SELECT * FROM rides WHERE end_time IS NOT NULL AND end_lock_id IS NOT NULL"),
)
def filter_not_null(t: Tables) -> DataFrame:
    return t.rides.where(F.col("end_time").isNotNull() & F.col("end_lock_id").isNotNull())


@query(
    "filter_between_dates",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-05-01' AND DATE '1996-05-10'",
)
def filter_between_dates(t: Tables) -> DataFrame:
    first, last = (F.lit(d).cast("date") for d in ("1996-05-01", "1996-05-10"))
    return t.orders.where(F.to_date("o_orderdate").between(first, last)).select("o_orderkey", "o_orderdate")


@query(
    "filter_nonempty_tokens",
    """SELECT doc_id, count(*) AS words FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
        WHERE word <> '' GROUP BY doc_id""",
)
def filter_nonempty_tokens(t: Tables) -> DataFrame:
    tokens = t.documents.select("doc_id", F.explode(text.words_of(F.col("text"))).alias("word"))
    return tokens.where(F.col("word") != "").groupBy("doc_id").agg(F.count(F.lit(1)).alias("words"))


@query(
    "filter_watermark_id",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > (SELECT coalesce(max(c_custkey), 0) FROM customer)",
)
def filter_watermark_id(t: Tables) -> DataFrame:
    return limits.above_watermark(t.orders, t.customer, "o_orderkey", "c_custkey").select("o_orderkey", "o_custkey")


@query(
    "filter_valid_interval",
    with_tables(
        "order_rides",
        """SELECT ride_id, start_time, end_time, end_time > start_time AS is_positive FROM order_rides
        WHERE start_time <= end_time""",
    ),
)
def filter_valid_interval(t: Tables) -> DataFrame:
    valid = t.order_rides.where(F.col("start_time") <= F.col("end_time"))
    return valid.select("ride_id", "start_time", "end_time", (F.col("end_time") > F.col("start_time")).alias("is_positive"))


@query(
    "adaptive_date_window",
    """WITH windows AS (
        SELECT days, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-05-01'
                      AND CAST(o_orderdate AS DATE) < DATE '1996-05-01' + days) AS n
        FROM (VALUES (2), (3), (10)) v(days)),
    chosen AS (SELECT coalesce(min(days) FILTER (WHERE n >= 30), 10) AS days FROM windows)
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) >= DATE '1996-05-01'
      AND CAST(o_orderdate AS DATE) < DATE '1996-05-01' + (SELECT days FROM chosen)""",
)
def adaptive_date_window(t: Tables) -> DataFrame:
    return limits.widening_window(t.orders, "o_orderdate", "1996-05-01", (2, 3, 10), 30).select("o_orderkey", "o_orderdate")


@query(
    "filter_as_of_date",
    with_tables("subscriptions", f"SELECT * FROM subscriptions WHERE valid_from <= TIMESTAMP '{AS_OF}'"),
)
def filter_as_of_date(t: Tables) -> DataFrame:
    return t.subscriptions.where(F.col("valid_from") <= F.lit(AS_OF).cast("timestamp_ntz"))


# --- dates ---------------------------------------------------------------------------------------


@query(
    "year_quarter_month_day",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter,
        CAST(month(o_orderdate) AS INT) AS month, CAST(day(o_orderdate) AS INT) AS day FROM orders""",
)
def year_quarter_month_day(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )


@query(
    "month_day_names",
    "SELECT o_orderkey, monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name FROM orders",
)
def month_day_names(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select("o_orderkey", dates.month_name(day).alias("month_name"), dates.day_name(day).alias("day_name"))


@query(
    "is_weekday_flag",
    """SELECT o_orderkey, dayofweek(o_orderdate) NOT IN (0, 6) AS is_weekday,
        CASE WHEN isodow(o_orderdate) < 6 THEN 'Y' ELSE 'N' END AS weekday_flag FROM orders""",
)
def is_weekday_flag(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", dates.is_weekday(day).alias("is_weekday"), dates.yes_no(F.weekday(day) < 5).alias("weekday_flag")
    )


@query(
    "dow_numbers",
    """SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INT) AS sunday_first,
        CAST(isodow(o_orderdate) AS INT) AS monday_first FROM orders""",
)
def dow_numbers(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.dayofweek(day).alias("sunday_first"), dates.monday_first(day).alias("monday_first"))


@query("date_int_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_int FROM orders")
def date_int_key(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.date_int(F.col("o_orderdate")).alias("date_int"))


@query(
    "is_last_day_of_month",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS is_month_end FROM orders",
)
def is_last_day_of_month(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.is_month_end(F.col("o_orderdate")).alias("is_month_end"))


@query(
    "day_of_year_iso_week",
    """SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INT) AS day_of_year,
        CAST(weekofyear(o_orderdate) AS INT) AS iso_week FROM orders""",
)
def day_of_year_iso_week(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.dayofyear("o_orderdate").alias("day_of_year"), F.weekofyear("o_orderdate").alias("iso_week")
    )


@query(
    "date_truncate",
    "SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events",
)
def date_truncate(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.to_date("ts").alias("day"), dates.hour_of(F.col("ts")).alias("hour"))


@query(
    "duration_seconds",
    with_tables(
        "order_rides",
        """SELECT ride_id, extract(epoch FROM end_time - start_time) AS seconds,
        extract(epoch FROM end_time - start_time) / 60.0::DOUBLE AS minutes,
        round(extract(epoch FROM end_time - start_time) / 3600.0::DOUBLE, 6) AS hours FROM order_rides""",
    ),
)
def duration_seconds(t: Tables) -> DataFrame:
    span = F.col("start_time"), F.col("end_time")
    return t.order_rides.select(
        "ride_id",
        dates.elapsed_seconds(*span).alias("seconds"),
        dates.elapsed_minutes(*span).alias("minutes"),
        F.round(dates.elapsed_hours(*span), 6).alias("hours"),
    )


@query(
    "from_epoch",
    with_tables(
        "weather",
        """SELECT event_id, make_timestamp(epoch * 1000000) AS moment,
        strftime(make_timestamp(epoch * 1000000), '%Y-%m-%d %H:00:00') AS hour_text FROM weather""",
    ),
)
def from_epoch(t: Tables) -> DataFrame:
    moment = dates.from_epoch(F.col("epoch"))
    return t.weather.select(
        "event_id", moment.alias("moment"), F.date_format(moment, "yyyy-MM-dd HH:00:00").alias("hour_text")
    )


@query(
    "parse_timestamp",
    """SELECT event_id, date_trunc('second', ts) AS moment, CAST(ts AS DATE) AS day FROM events""",
)
def parse_timestamp(t: Tables) -> DataFrame:
    written = t.events.select(
        "event_id", dates.format_timestamp(F.col("ts")).alias("a"), F.date_format("ts", "yyyyMMdd").alias("b")
    )
    return written.select(
        "event_id",
        F.to_timestamp_ntz(F.col("a"), F.lit(dates.TIMESTAMP_PATTERN)).alias("moment"),
        F.to_date("b", "yyyyMMdd").alias("day"),
    )


@query("format_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM events")
def format_timestamp(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.format_timestamp(F.col("ts")).alias("moment"))


@query("day_name_label", "SELECT event_id, dayname(ts) AS day_name FROM events")
def day_name_label(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.day_name(F.col("ts")).alias("day_name"))


@query(
    "day_type_case",
    with_tables(
        "rides",
        """SELECT subscription_id, start_time, CASE WHEN dayofweek(end_time) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
        FROM rides""",
    ),
)
def day_type_case(t: Tables) -> DataFrame:
    return t.rides.select("subscription_id", "start_time", dates.day_type(F.col("end_time")).alias("day_type"))


# --- distances and weather -----------------------------------------------------------------------

HAVERSINE = """CASE WHEN {a} IS NULL OR {b} IS NULL OR {c} IS NULL OR {d} IS NULL THEN NULL
    WHEN {a} = {c} AND {b} = {d} THEN 0.0::DOUBLE ELSE 6371 * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
    cos(radians({a})) * cos(radians({c})) * cos(radians({d}) - radians({b})) + sin(radians({a})) * sin(radians({c}))))) END"""
RIDE_LEG = HAVERSINE.format(a="start_lat", b="start_lon", c="end_lat", d="end_lon")
STATION_LEG = HAVERSINE.format(a="a.lat", b="a.lon", c="b.lat", d="b.lon")


def _ride_points() -> list:
    return [F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")]


@query(
    "euclid_degrees_km",
    with_tables(
        "rides",
        """SELECT subscription_id, vehicle_id,
        round(sqrt(pow(start_lat - end_lat, 2) + pow(start_lon - end_lon, 2)) * 111.32::DOUBLE, 4) AS km FROM rides""",
    ),
)
def euclid_degrees_km(t: Tables) -> DataFrame:
    return t.rides.select(
        "subscription_id", "vehicle_id", F.round(geo.degree_distance_km(*_ride_points()), 4).alias("km")
    )


@query("haversine_km", with_tables("order_rides", f"SELECT ride_id, round({RIDE_LEG}, 3) AS km FROM order_rides"))
def haversine_km(t: Tables) -> DataFrame:
    return t.order_rides.select("ride_id", F.round(geo.great_circle_km(*_ride_points()), 3).alias("km"))


@query(
    "distance_with_fallback",
    with_tables(
        "order_rides lock_places",
        f"""SELECT ride_id, round(coalesce({RIDE_LEG}, {STATION_LEG}, 0), 3) AS km FROM order_rides
        LEFT JOIN lock_places a ON a.lock_id = start_lock_id LEFT JOIN lock_places b ON b.lock_id = end_lock_id""",
    ),
)
def distance_with_fallback(t: Tables) -> DataFrame:
    from wheelhouse.operators.joins import lookup, sized

    rides = t.order_rides
    (places,) = sized(t.lock_places)
    for side in ("start", "end"):
        rides = lookup(rides, places, {f"{side}_lock_id": "lock_id"}, {f"{side}_slat": "lat", f"{side}_slon": "lon"})
    stations = [F.col(c) for c in ("start_slat", "start_slon", "end_slat", "end_slon")]
    km = geo.first_known_distance_km(tuple(_ride_points()), tuple(stations))
    return rides.select("ride_id", F.round(km, 3).alias("km"))


@query(
    "speed_kmh",
    with_tables(
        "rides",
        """SELECT subscription_id, vehicle_id, round(sqrt(pow(start_lat - end_lat, 2) + pow(start_lon - end_lon, 2)) * 111.32::DOUBLE
        / nullif(extract(epoch FROM end_time - start_time) / 3600.0::DOUBLE, 0), 4) AS kmh FROM rides""",
    ),
)
def speed_kmh(t: Tables) -> DataFrame:
    hours = dates.elapsed_hours(F.col("start_time"), F.col("end_time"))
    speed = geo.speed_kmh(geo.degree_distance_km(*_ride_points()), hours)
    return t.rides.select("subscription_id", "vehicle_id", F.round(speed, 4).alias("kmh"))


@query("kelvin_to_celsius", with_tables("weather", "SELECT event_id, round(kelvin - 273.15::DOUBLE, 4) AS celsius FROM weather"))
def kelvin_to_celsius(t: Tables) -> DataFrame:
    return t.weather.select("event_id", F.round(weather.celsius(F.col("kelvin")), 4).alias("celsius"))


@query(
    "pseudo_random_speed",
    "SELECT o_orderkey, 4.0::DOUBLE + (o_orderkey % 300) / 100.0::DOUBLE AS metres_per_second FROM orders",
)
def pseudo_random_speed(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", geo.assumed_speed(F.col("o_orderkey")).alias("metres_per_second"))


@query(
    "point_xy",
    "SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS x, -CAST(o_custkey AS DOUBLE) AS y FROM orders",
)
def point_xy(t: Tables) -> DataFrame:
    key, other = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    bracketed = F.concat(F.lit("("), key, F.lit(",-"), other, F.lit(")"))
    bare = F.concat(key, F.lit(", -"), other)
    written = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", bracketed).otherwise(bare).alias("p"))
    return written.select("o_orderkey", geo.parse_point(F.col("p")).alias("p")).select("o_orderkey", "p.x", "p.y")


@query(
    "weather_category_a",
    with_tables(
        "weather",
        """SELECT event_id, CASE WHEN condition IN ('Rain', 'Snow', 'Thunderstorm', 'Drizzle') THEN 2
        WHEN condition = 'Clear' AND kelvin - 273.15::DOUBLE > 15.0::DOUBLE THEN 1 ELSE 3 END AS weather_id FROM weather""",
    ),
)
def weather_category_a(t: Tables) -> DataFrame:
    rule = weather.weather_id(F.col("condition"), weather.celsius(F.col("kelvin")))
    return t.weather.select("event_id", rule.alias("weather_id"))


@query(
    "weather_category_b",
    with_tables(
        "weather",
        """SELECT event_id, CASE WHEN condition LIKE '%rain%' OR condition = 'Rain' THEN 'Unpleasant'
        WHEN condition = 'Clear' AND kelvin > 288.15::DOUBLE THEN 'Pleasant' ELSE 'Neutral' END AS weather_type FROM weather""",
    ),
)
def weather_category_b(t: Tables) -> DataFrame:
    return t.weather.select("event_id", weather.weather_type(F.col("condition"), F.col("kelvin")).alias("weather_type"))


@query("register_haversine_sql", with_tables("order_rides", f"SELECT ride_id, round({RIDE_LEG}, 3) AS km FROM order_rides"))
def register_haversine_sql(t: Tables) -> DataFrame:
    geo.register_great_circle(t.spark)
    return t.order_rides.selectExpr(
        "ride_id", "round(great_circle_km(start_lat, start_lon, end_lat, end_lon), 3) AS km"
    )


# --- hashes, text and JSON -----------------------------------------------------------------------


@query(
    "md5_row_hash",
    with_tables(
        "users",
        """SELECT user_id, md5(coalesce(street, '') || '|' || coalesce(number, '') || '|' || coalesce(zipcode, '') || '|'
        || coalesce(city, '') || '|' || coalesce(country_code, '')) AS md5 FROM users""",
    ),
)
def md5_row_hash(t: Tables) -> DataFrame:
    columns = [F.col(c) for c in ("street", "number", "zipcode", "city", "country_code")]
    return t.users.select("user_id", hashing.row_hash(*columns).alias("md5"))


@query(
    "md5_concat_hash",
    with_tables(
        "users",
        """SELECT user_id, md5(street || number || zipcode) AS md5 FROM users""",
    ),
)
def md5_concat_hash(t: Tables) -> DataFrame:
    return t.users.select("user_id", hashing.plain_hash(*(F.col(c) for c in ("street", "number", "zipcode"))).alias("md5"))


@query(
    "string_clean",
    """SELECT lang, count(*) AS words, CAST(sum(length(word)) AS BIGINT) AS letters
        FROM (SELECT lang, lower(trim(unnest(string_split(text, ' ')))) AS word FROM documents)
        WHERE word <> '' GROUP BY lang""",
)
def string_clean(t: Tables) -> DataFrame:
    tokens = t.documents.select("lang", F.explode(text.words_of(F.col("text"))).alias("word"))
    cleaned = tokens.select("lang", text.clean_word(F.col("word")).alias("word")).where(F.col("word") != "")
    return cleaned.groupBy("lang").agg(F.count(F.lit(1)).alias("words"), F.sum(F.length("word")).alias("letters"))


@query(
    "string_escape_quote",
    "SELECT doc_id, md5('''' || replace(text, '''', '''''') || '''') AS literal_md5 FROM documents",
)
def string_escape_quote(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.sql_text(F.col("text"))).alias("literal_md5"))


@query(
    "string_concat_optional",
    with_tables("users", "SELECT user_id, street || coalesce(' ' || number, '') AS line FROM users"),
)
def string_concat_optional(t: Tables) -> DataFrame:
    return t.users.select("user_id", text.street_line(F.col("street"), F.col("number")).alias("line"))


@query("string_contains", "SELECT doc_id, contains(text, 'the') AS has_the FROM documents")
def string_contains(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.contains(F.col("text"), F.lit("the")).alias("has_the"))


@query("first_letter", "SELECT doc_id, substr(text, 1, 1) AS letter FROM documents")
def first_letter(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.first_letter(F.col("text")).alias("letter"))


@query(
    "null_defaults",
    with_tables(
        "order_rides",
        """SELECT ride_id, coalesce(end_lock_id, -1) AS end_lock_id, nullif(vehicle_id, 0) AS vehicle_id,
        coalesce(CAST(start_lock_id AS VARCHAR), 'NULL') AS start_lock_text FROM order_rides""",
    ),
)
def null_defaults(t: Tables) -> DataFrame:
    return t.order_rides.select(
        "ride_id",
        F.coalesce("end_lock_id", F.lit(-1)).alias("end_lock_id"),
        F.nullif(F.col("vehicle_id"), F.lit(0)).alias("vehicle_id"),
        text.sql_number(F.col("start_lock_id")).alias("start_lock_text"),
    )


@query(
    "json_path_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""",
)
def json_path_extract(t: Tables) -> DataFrame:
    props = F.col("props")
    return t.events.select(
        "event_id",
        F.get_json_object(props, "$.k").cast("long").alias("k"),
        F.get_json_object(props, "$.missing").alias("missing"),
    )


@query(
    "json_tuple_extract",
    """SELECT event_id, json_extract_string(props, '$.k') AS c0, json_extract_string(props, '$.missing') AS c1 FROM events""",
)
def json_tuple_extract(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.json_tuple("props", "k", "missing").alias("c0", "c1"))


@query(
    "unique_ids",
    f"SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR) || '|{REP_RUN}') AS version_key FROM customer",
)
def unique_ids(t: Tables) -> DataFrame:
    start = F.lit(REP_RUN).cast("timestamp_ntz")
    return t.customer.select("c_custkey", hashing.version_key(F.col("c_custkey"), start).alias("version_key"))


@query(
    "sort_array_index",
    """SELECT doc_id, string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[500] AS far_word FROM documents""",
)
def sort_array_index(t: Tables) -> DataFrame:
    words = text.words_of(F.col("text"))
    return t.documents.select(
        "doc_id", F.get(words, F.lit(0)).alias("first_word"), F.get(words, F.lit(499)).alias("far_word")
    )


@query(
    "prefixed_ids",
    """SELECT 'u-' || CAST(o_custkey AS VARCHAR) AS user_node, 'r-' || CAST(o_orderkey AS VARCHAR) AS ride_node FROM orders""",
)
def prefixed_ids(t: Tables) -> DataFrame:
    return t.orders.select(
        text.prefixed("u", F.col("o_custkey")).alias("user_node"), text.prefixed("r", F.col("o_orderkey")).alias("ride_node")
    )


@query(
    "rdd_lambda_maps",
    """SELECT doc_id, CAST(len(w) AS BIGINT) AS words, CAST(list_max(list_transform(w, lambda x: length(x))) AS BIGINT) AS longest
        FROM (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM documents)""",
)
def rdd_lambda_maps(t: Tables) -> DataFrame:
    words = F.filter(text.words_of(F.col("text")), lambda w: w != "")
    lengths = F.transform(words, lambda w: F.length(w))
    return t.documents.select(
        "doc_id", F.size(words).cast("long").alias("words"), F.array_max(lengths).cast("long").alias("longest")
    )
