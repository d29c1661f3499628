"""Dimensions, facts, graph and the named analytics queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.catalog.bindings import Tables, with_tables
from wheelhouse.catalog.expressions import RIDE_LEG, STATION_LEG
from wheelhouse.catalog.registry import query
from wheelhouse.functions import weather
from wheelhouse.operators import limits
from wheelhouse.operators.distinct import bitmaps, counted
from wheelhouse.operators.joins import sized
from wheelhouse.operators.layout import spread
from wheelhouse.plans import dimensions, facts, graph, rides, sales, words
from wheelhouse.session import scratch_dir
from wheelhouse.sinks.batches import BatchTable
from wheelhouse.sinks.files import staged, write_all, write_parquet
from wheelhouse.sources import generated, variants
from wheelhouse.sources.files import read_optional, read_parquet

AS_OF = "1998-12-31 00:00:00"

# --- dimensions ----------------------------------------------------------------------------------


@query("gen_date_sequence", with_tables("days", "SELECT origin, date FROM days"))
def gen_date_sequence(t: Tables) -> DataFrame:
    return generated.dates_covering(t.orders, "o_orderdate")


@query("dim_date_ride", with_tables("dim_date", "SELECT * FROM dim_date"))
def dim_date_ride(t: Tables) -> DataFrame:
    return t.dim_date


@query("dim_date_calendar", with_tables("calendar", "SELECT * FROM calendar"))
def dim_date_calendar(t: Tables) -> DataFrame:
    return t.calendar


MEMBER_USE = """SELECT m.weather_id, m.weather_type, count(r.event_id) AS reports FROM weather_members m
        LEFT JOIN (SELECT event_id, CASE WHEN condition IN ('Rain', 'Snow', 'Thunderstorm', 'Drizzle') THEN 2
                   WHEN condition = 'Clear' AND kelvin - 273.15::DOUBLE > 15 THEN 1 ELSE 3 END AS weather_id FROM weather) r
        ON r.weather_id = m.weather_id GROUP BY m.weather_id, m.weather_type"""


def _members_in_use(t: Tables) -> DataFrame:
    rule = weather.weather_id(F.col("condition"), weather.celsius(F.col("kelvin")))
    used = t.weather.groupBy(rule.alias("weather_id")).agg(F.count(F.lit(1)).alias("reports"))
    members = dimensions.weather_members(t.spark).join(used, "weather_id", "left")
    return members.select("weather_id", "weather_type", F.coalesce("reports", F.lit(0)).alias("reports"))


@query("dim_weather", with_tables("weather weather_members", MEMBER_USE))
def dim_weather(t: Tables) -> DataFrame:
    """The four members and how many weather reports fall to each."""
    return _members_in_use(t)


@query(
    "scan_inline_rows",
    with_tables(
        "weather weather_members",
        """SELECT m.weather_type, count(event_id) AS reports FROM weather_members m LEFT JOIN (
            SELECT event_id, CASE WHEN condition LIKE '%rain%' OR condition = 'Rain' THEN 'Unpleasant'
            WHEN condition = 'Clear' AND kelvin > 288.15::DOUBLE THEN 'Pleasant' ELSE 'Neutral' END AS weather_type FROM weather) r
        ON r.weather_type = m.weather_type GROUP BY m.weather_type""",
    ),
)
def scan_inline_rows(t: Tables) -> DataFrame:
    """Literal members joined to the reports that fall to them."""
    members = generated.inline_rows(t.spark, weather.WEATHER_MEMBERS, "weather_id int, weather_type string")
    rule = weather.weather_type(F.col("condition"), F.col("kelvin"))
    used = t.weather.groupBy(rule.alias("weather_type")).agg(F.count(F.lit(1)).alias("n"))
    return members.join(used, "weather_type", "left").select("weather_type", F.coalesce("n", F.lit(0)).alias("reports"))


@query(
    "weather_staging",
    with_tables(
        "weather",
        """SELECT zipcode AS postal_code, make_timestamp(epoch * 1000000) AS timestamp, condition AS weather_condition,
        round(kelvin - 273.15::DOUBLE, 4) AS temperature,
        CASE WHEN condition IN ('Rain', 'Snow', 'Thunderstorm', 'Drizzle') THEN 2
             WHEN condition = 'Clear' AND kelvin - 273.15::DOUBLE > 15 THEN 1 ELSE 3 END AS weather_id FROM weather""",
    ),
)
def weather_staging(t: Tables) -> DataFrame:
    staged = dimensions.weather_staging(t.weather_documents)
    return staged.withColumn("temperature", F.round("temperature", 4))


@query("weather_hourly", with_tables("weather_hourly", "SELECT * FROM weather_hourly"))
def weather_hourly(t: Tables) -> DataFrame:
    return dimensions.weather_hourly(t.weather_documents)


@query(
    "dim_vehicle",
    with_tables(
        "vehicles lots bike_types",
        "SELECT vehicle_id, description AS type FROM vehicles JOIN lots USING (lot_id) JOIN bike_types USING (bike_type_id)",
    ),
)
def dim_vehicle(t: Tables) -> DataFrame:
    return dimensions.vehicles(t.vehicles, t.lots, t.bike_types)


@query("dim_lock", with_tables("dim_lock", "SELECT * FROM dim_lock"))
def dim_lock(t: Tables) -> DataFrame:
    return t.dim_lock


# --- facts ---------------------------------------------------------------------------------------

MEASURES = f"""SELECT ride_id, user_id, start_lock_id, end_lock_id, start_time, end_time,
        extract(epoch FROM end_time - start_time) / 60.0::DOUBLE AS ride_duration,
        round(coalesce({RIDE_LEG}, {STATION_LEG}, 0), 3) AS ride_distance,
        CAST(start_time AS DATE) AS ride_date, CAST(date_trunc('hour', start_time) AS TIMESTAMP) AS start_hour,
        coalesce(a.zipcode, '0000') AS start_postal_code, coalesce(vehicle_id, 0) AS vehicle_id
        FROM order_rides LEFT JOIN lock_places a ON a.lock_id = start_lock_id
        LEFT JOIN lock_places b ON b.lock_id = end_lock_id LEFT JOIN subscriptions USING (subscription_id)
        WHERE start_time <= end_time"""
FACTS = """SELECT ride_id, coalesce(date_sk, -1) AS date_sk, coalesce(user_sk, '-1') AS user_sk,
        coalesce(ls.lock_id, -1) AS start_lock_id, coalesce(le.lock_id, -1) AS end_lock_id,
        coalesce(weather_id, -1) AS weather_id, vehicle_id, ride_distance, ride_duration
        FROM measures m LEFT JOIN dim_date ON date = ride_date
        LEFT JOIN dim_user u ON u.user_id = m.user_id AND u.is_current
        LEFT JOIN dim_lock ls ON ls.lock_id = start_lock_id LEFT JOIN dim_lock le ON le.lock_id = end_lock_id
        LEFT JOIN weather_hourly w ON w.zipcode = start_postal_code AND w.weather_hour = start_hour
        LEFT JOIN weather_members d ON d.weather_type = coalesce(w.weather_type, 'Unknown')"""
FACT_TABLES = "order_rides lock_places subscriptions dim_date dim_user dim_lock weather_hourly weather_members"


def ride_dimensions(t: Tables) -> facts.RideDimensions:
    """The dimensions of the ride fact; the weather is parsed once and kept as a staging table."""
    hourly = staged(dimensions.weather_hourly(t.weather_documents), "weather-hourly")
    opened = facts.RideDimensions(
        t.dim_date, dimensions.weather_members(t.spark), t.dim_user, t.dim_lock, t.lock_places, hourly
    )
    return opened.counted()


def measured(t: Tables, source: DataFrame, places: DataFrame) -> DataFrame:
    measures = facts.ride_measures(source, places, t.subscriptions)
    return measures.withColumn("ride_distance", F.round("ride_distance", 3))


def fact_rides(t: Tables, user_lookup: str = "current") -> DataFrame:
    opened = ride_dimensions(t)
    return facts.ride_facts(measured(t, t.order_rides, opened.places), opened, user_lookup)


@query("ride_measures", with_tables("order_rides lock_places subscriptions", MEASURES))
def ride_measures(t: Tables) -> DataFrame:
    (places,) = sized(t.lock_places)
    return measured(t, t.order_rides, places)


@query("fact_ride_lookup", with_tables(FACT_TABLES, FACTS, measures=MEASURES))
def fact_ride_lookup(t: Tables) -> DataFrame:
    return fact_rides(t)


@query(
    "fact_ride_asof",
    with_tables(
        FACT_TABLES,
        FACTS.replace("AND u.is_current", "AND start_time > u.start_date AND start_time <= u.end_date"),
        measures=MEASURES,
    ),
)
def fact_ride_asof(t: Tables) -> DataFrame:
    """The user version that was valid when the ride started."""
    return fact_rides(t, "asof")


SALES_FACTS = """SELECT order_id, date_sk, salesrep_sk, 1 AS count_mv, amount AS revenue_mv,
        md5(CAST(order_id AS VARCHAR) || CAST(date_sk AS VARCHAR) || salesrep_sk || '1'
            || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR)) AS md5
        FROM {sales} s LEFT JOIN calendar ON calendar_date = CAST(order_date AS DATE)
        LEFT JOIN dim_salesrep d ON d.salesrep_id = s.salesrep_id AND order_date > scd_start AND order_date <= scd_end"""


@query("fact_ride_incremental", with_tables(FACT_TABLES, FACTS, measures=MEASURES))
def fact_ride_incremental(t: Tables) -> DataFrame:
    """A first load up to the greatest customer key, and one more run that appends what came after it.

    The fact lies in folders by the year of the ride's start, so the second run looks for loaded rides in those years
    alone that its own rides have.
    """
    opened = ride_dimensions(t)
    border = limits.high_watermark(t.customer, "c_custkey")
    dated = t.order_rides.withColumn("ride_year", F.year("start_time"))

    def load(source: DataFrame) -> DataFrame:
        built = facts.ride_facts(measured(t, source, opened.places), opened)
        return facts.with_year(built, t.dim_date).drop("month").withColumnRenamed("year", "ride_year")

    table = BatchTable(t.spark, scratch_dir(t.spark, "fact-ride"), load(dated.limit(0)).schema, ["ride_year"])
    table.load("up to the border", load(dated.where(F.col("ride_id") <= border)))
    table.load("after it", load(table.unloaded(dated, ["ride_id"])))
    return table.read().drop("ride_year")


@query(
    "fact_sales_resumed",
    with_tables(
        "sales calendar dim_salesrep",
        "SELECT f.*, CAST(year(order_date) AS INT) AS order_year FROM facts f JOIN sales USING (order_id)",
        facts=SALES_FACTS.format(sales="sales"),
    ),
)
def fact_sales_resumed(t: Tables) -> DataFrame:
    """Sales in three batches; the first run ends after two of them, the second one goes on, the third finds nothing."""
    reps = staged(t.dim_salesrep, "dim-salesrep")
    sales = t.sales.withColumn("order_year", F.year("order_date"))

    def load(source: DataFrame) -> DataFrame:
        years = source.select("order_id", "order_year")
        return facts.sales_facts(source.drop("order_year"), t.calendar, reps).join(years, "order_id")

    table = BatchTable(t.spark, scratch_dir(t.spark, "fact-sales"), load(sales.limit(0)).schema, ["order_year"])
    for batches in ((0, 1), (0, 1, 2)):
        for batch in batches:
            table.load(f"sales {batch} of 3", load(sales.where(F.col("order_id") % 3 == batch)))
    table.load("late", load(table.unloaded(sales, ["order_id"])))
    return table.read()


@query("fact_sales_asof", with_tables("sales calendar dim_salesrep", SALES_FACTS.format(sales="sales")))
def fact_sales_asof(t: Tables) -> DataFrame:
    return facts.sales_facts(t.sales, t.calendar, t.dim_salesrep)


@query(
    "fact_sales_merge",
    with_tables(
        "sales late_sales calendar dim_salesrep",
        """SELECT o.order_id, o.date_sk, o.salesrep_sk, o.count_mv,
            CASE WHEN n.md5 <> o.md5 THEN n.revenue_mv ELSE o.revenue_mv END AS revenue_mv,
            CASE WHEN n.md5 <> o.md5 THEN n.md5 ELSE o.md5 END AS md5
        FROM old o LEFT JOIN new n ON n.order_id = o.order_id
        UNION ALL SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.order_id = n.order_id)""",
        old=SALES_FACTS.format(sales="sales"),
        new=SALES_FACTS.format(sales="late_sales"),
    ),
)
def fact_sales_merge(t: Tables) -> DataFrame:
    """Facts without a hash keep their old revenue, as an unknown comparison changes nothing."""
    reps = staged(t.dim_salesrep, "dim-salesrep")
    old = facts.sales_facts(t.sales, t.calendar, reps)
    new = staged(facts.sales_facts(t.late_sales, t.calendar, reps), "sales-increment")
    return facts.merge_sales_facts(old, new)


@query(
    "fact_export_by_year",
    with_tables(
        FACT_TABLES,
        "SELECT f.*, year, month_nr AS month FROM facts f LEFT JOIN dim_date d ON d.date_sk = f.date_sk",
        measures=MEASURES,
        facts=FACTS,
    ),
)
def fact_export_by_year(t: Tables) -> DataFrame:
    return facts.with_year(fact_rides(t), t.dim_date)


# --- graph ---------------------------------------------------------------------------------------

BASE = """SELECT ride_id, start_time, end_time, vehicle_id, serial_number, user_id, email, city,
        a.station_id AS start_station_id, a.street AS start_street, a.district AS start_district,
        a.number AS start_number, a.zipcode AS start_zipcode, b.station_id AS end_station_id, b.street AS end_street,
        b.district AS end_district, b.number AS end_number, b.zipcode AS end_zipcode
        FROM order_rides JOIN vehicles USING (vehicle_id) JOIN subscriptions USING (subscription_id)
        JOIN users USING (user_id) JOIN locks la ON la.lock_id = start_lock_id
        JOIN stations a ON a.station_id = la.station_id
        LEFT JOIN locks lb ON lb.lock_id = end_lock_id LEFT JOIN stations b ON b.station_id = lb.station_id"""
GRAPH_TABLES = "order_rides vehicles subscriptions users locks stations"
NODES = """SELECT DISTINCT 'd-' || district AS id, 'District' AS label, to_json({name: district}) AS properties FROM stations
        UNION ALL SELECT DISTINCT 's-' || station_id, 'Station', to_json({name: street || coalesce(' ' || number, ''),
            stationId: station_id, zipcode: zipcode}) FROM stations
        UNION ALL SELECT DISTINCT 'u-' || user_id, 'User', to_json({city: city, email: email, userId: user_id}) FROM base
        UNION ALL SELECT DISTINCT 'v-' || vehicle_id, 'Vehicle', to_json({serialNumber: serial_number, vehicleId: vehicle_id}) FROM base
        UNION ALL SELECT 'r-' || ride_id, 'Ride', to_json({duration: CAST(extract(epoch FROM end_time - start_time) AS DOUBLE),
            endTime: strftime(end_time, '%Y-%m-%d %H:%M:%S'), rideId: ride_id,
            startTime: strftime(start_time, '%Y-%m-%d %H:%M:%S')}) FROM base"""
EDGES = """SELECT 'sd-' || station_id AS id, 'LOCATED_IN' AS type, 's-' || station_id AS startNode, 'd-' || district AS endNode
            FROM stations
        UNION ALL SELECT 'rs-' || ride_id, 'STARTS_AT', 'r-' || ride_id, 's-' || start_station_id FROM base
        UNION ALL SELECT 're-' || ride_id, 'ENDS_AT', 'r-' || ride_id, 's-' || end_station_id FROM base WHERE end_station_id IS NOT NULL
        UNION ALL SELECT 'rv-' || ride_id, 'USES', 'r-' || ride_id, 'v-' || vehicle_id FROM base
        UNION ALL SELECT 'ru-' || ride_id, 'TAKEN_BY', 'r-' || ride_id, 'u-' || user_id FROM base"""


def graph_base(t: Tables) -> DataFrame:
    return graph.ride_base(t.order_rides, t.vehicles, t.subscriptions, t.users, t.locks, t.stations)


@query("graph_ride_base", with_tables(GRAPH_TABLES, BASE))
def graph_ride_base(t: Tables) -> DataFrame:
    return graph_base(t)


@query("graph_nodes", with_tables(GRAPH_TABLES, NODES, base=BASE))
def graph_nodes(t: Tables) -> DataFrame:
    found = graph.nodes(staged(graph_base(t), "ride-base"), t.stations)
    return found.select("id", F.col("labels")[0].alias("label"), F.to_json("properties").alias("properties"))


@query("graph_edges", with_tables(GRAPH_TABLES, EDGES, base=BASE))
def graph_edges(t: Tables) -> DataFrame:
    return graph.edges(graph_base(t), t.stations).drop("properties")


@query(
    "graph_degree_summary",
    with_tables(
        GRAPH_TABLES,
        """SELECT 'node' AS element, label AS name, count(*) AS total FROM nodes GROUP BY label
        UNION ALL SELECT 'relationship', type, count(*) FROM edges GROUP BY type""",
        base=BASE,
        nodes=NODES,
        edges=EDGES,
    ),
)
def graph_degree_summary(t: Tables) -> DataFrame:
    base = staged(graph_base(t), "ride-base")
    return graph.summary(graph.nodes(base, t.stations), graph.edges(base, t.stations))


# --- ride analytics ------------------------------------------------------------------------------

SECONDS = "extract(epoch FROM r.end_time - r.start_time)"


@query(
    "rides_by_city_zip",
    with_tables(
        "rides subscriptions users",
        """SELECT city, zipcode, count(*) AS ride_count FROM rides r JOIN subscriptions s USING (subscription_id)
        JOIN users u ON u.user_id = s.user_id WHERE r.start_time >= s.valid_from GROUP BY city, zipcode""",
    ),
)
def rides_by_city_zip(t: Tables) -> DataFrame:
    return rides.rides_by_city(t.rides, t.subscriptions, t.users).select(
        "city", "zipcode", "ride_count"
    )


@query(
    "avg_duration_per_user",
    with_tables(
        "rides subscriptions",
        f"""SELECT round(avg(a), 4) AS overall_avg_ride_duration_minutes FROM (SELECT avg({SECONDS} / 60) AS a FROM rides r
        JOIN subscriptions s USING (subscription_id) WHERE r.end_time IS NOT NULL AND {SECONDS} >= 0 GROUP BY s.user_id)""",
    ),
)
def avg_duration_per_user(t: Tables) -> DataFrame:
    return rides.average_user_duration(t.rides, t.subscriptions)


@query(
    "weekday_weekend_rides",
    with_tables(
        "rides subscriptions",
        """SELECT CASE WHEN extract(dow FROM start_time) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
        count(*) AS ride_count FROM rides JOIN subscriptions USING (subscription_id) GROUP BY day_type""",
    ),
)
def weekday_weekend_rides(t: Tables) -> DataFrame:
    return rides.rides_by_day_type(t.rides, t.subscriptions)


@query(
    "avg_duration_by_day_name",
    with_tables(
        "rides",
        f"""SELECT dayname(start_time) AS day_of_week, round(avg({SECONDS} / 60), 4) AS avg_ride_duration_minutes FROM rides r
        WHERE end_time IS NOT NULL AND {SECONDS} > 0 AND subscription_id IS NOT NULL GROUP BY day_of_week""",
    ),
)
def avg_duration_by_day_name(t: Tables) -> DataFrame:
    return rides.duration_by_day_name(t.rides)


@query(
    "station_popularity",
    with_tables(
        "rides locks stations",
        """SELECT st.station_id, station_nr, street, coalesce(n, 0) AS usage_count FROM stations st LEFT JOIN (
            SELECT station_id, count(*) AS n FROM (
                SELECT start_lock_id AS lock_id FROM rides WHERE start_lock_id IS NOT NULL
                UNION ALL SELECT end_lock_id FROM rides WHERE end_lock_id IS NOT NULL) JOIN locks USING (lock_id)
            GROUP BY station_id) u ON u.station_id = st.station_id""",
    ),
)
def station_popularity(t: Tables) -> DataFrame:
    return rides.station_popularity(t.rides, t.locks, t.stations)


TYPED = "JOIN vehicles USING (vehicle_id) JOIN lots USING (lot_id) JOIN bike_types b USING (bike_type_id)"
STRAIGHT = "sqrt(pow(start_lat - end_lat, 2) + pow(start_lon - end_lon, 2)) * 111.32::DOUBLE"


@query(
    "rides_by_bike_type",
    with_tables(
        "rides vehicles lots bike_types",
        f"""SELECT description, count(*) AS ride_count FROM rides {TYPED}
        WHERE subscription_id IS NOT NULL AND end_time > start_time GROUP BY description""",
    ),
)
def rides_by_bike_type(t: Tables) -> DataFrame:
    return rides.rides_by_bike_type(t.rides, t.vehicles, t.lots, t.bike_types)


@query(
    "user_retention_rate",
    with_tables(
        "order_rides subscriptions",
        """SELECT round(count(CASE WHEN n > 1 THEN 1 END) * 100.0::DOUBLE / count(*), 4) AS retention_rate_percentage
        FROM (SELECT user_id, count(*) AS n FROM order_rides JOIN subscriptions USING (subscription_id) GROUP BY user_id)""",
    ),
)
def user_retention_rate(t: Tables) -> DataFrame:
    return rides.retention_rate(t.order_rides, t.subscriptions)


@query(
    "avg_speed_by_bike_type",
    with_tables(
        "rides subscriptions vehicles lots bike_types",
        f"""SELECT description, round(avg({STRAIGHT} / nullif({SECONDS} / 3600, 0)), 4) AS avg_speed_kmh FROM rides r {TYPED}
        JOIN subscriptions USING (subscription_id) WHERE {SECONDS} > 0 GROUP BY description""",
    ),
)
def avg_speed_by_bike_type(t: Tables) -> DataFrame:
    return rides.speed_by_bike_type(t.rides, t.vehicles, t.lots, t.bike_types, t.subscriptions)


@query(
    "avg_distance_by_bike_type",
    with_tables(
        "rides subscriptions vehicles lots bike_types",
        f"""SELECT description, round(avg({STRAIGHT}), 4) AS avg_distance_km FROM rides r {TYPED}
        JOIN subscriptions USING (subscription_id) WHERE {SECONDS} > 0 GROUP BY description""",
    ),
)
def avg_distance_by_bike_type(t: Tables) -> DataFrame:
    return rides.distance_by_bike_type(t.rides, t.vehicles, t.lots, t.bike_types, t.subscriptions)


@query(
    "revenue_by_subscription_type",
    with_tables(
        "rides subscriptions subscription_types",
        f"""SELECT description AS subscription_type, count(subscription_id) AS num_subscriptions,
        round(sum({SECONDS} / 3600) * 10, 4) AS estimated_revenue FROM subscriptions
        JOIN subscription_types USING (subscription_type_id) JOIN rides r USING (subscription_id)
        WHERE valid_from <= TIMESTAMP '{AS_OF}' GROUP BY description""",
    ),
)
def revenue_by_subscription_type(t: Tables) -> DataFrame:
    return rides.revenue_by_subscription_type(t.rides, t.subscriptions, t.subscription_types, AS_OF)


@query(
    "rides_per_user_by_year",
    with_tables(
        "rides subscriptions",
        f"""SELECT CAST(year(start_time) AS INT) AS ride_year, count(*) AS total_rides, count(DISTINCT user_id) AS total_users,
        CAST(count(*) // nullif(count(DISTINCT user_id), 0) AS BIGINT) AS avg_rides_per_user
        FROM rides r JOIN subscriptions USING (subscription_id) WHERE {SECONDS} > 0 GROUP BY ride_year""",
    ),
)
def rides_per_user_by_year(t: Tables) -> DataFrame:
    return rides.rides_per_user_by_year(t.rides, t.subscriptions)


# --- sales analytics and words -------------------------------------------------------------------


@query(
    "revenue_by_weekday",
    with_tables(
        "sales calendar dim_salesrep",
        """SELECT day_of_week, round(sum(revenue_mv), 2) AS revenue FROM facts JOIN calendar USING (date_sk) GROUP BY day_of_week""",
        facts=SALES_FACTS.format(sales="sales"),
    ),
)
def revenue_by_weekday(t: Tables) -> DataFrame:
    reps = staged(t.dim_salesrep, "dim-salesrep")
    return sales.revenue_by_weekday(facts.sales_facts(t.sales, t.calendar, reps), t.calendar)


@query(
    "revenue_by_office",
    with_tables(
        "sales calendar dim_salesrep",
        """SELECT office, round(sum(revenue_mv), 2) AS revenue FROM facts JOIN dim_salesrep USING (salesrep_sk) GROUP BY office""",
        facts=SALES_FACTS.format(sales="sales"),
    ),
)
def revenue_by_office(t: Tables) -> DataFrame:
    reps = staged(t.dim_salesrep, "dim-salesrep")
    return sales.revenue_by_office(facts.sales_facts(t.sales, t.calendar, reps), reps)


@query(
    "top_words",
    """SELECT word, count(*) AS amount FROM (SELECT lower(trim(unnest(string_split(text, ' ')))) AS word FROM documents)
        WHERE word <> '' GROUP BY word ORDER BY amount DESC, word LIMIT 20""",
)
def top_words(t: Tables) -> DataFrame:
    return words.top_words(spread(t.documents.select("text")), "text")


@query(
    "word_counts",
    """SELECT word, count(*) AS amount FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
)
def word_counts(t: Tables) -> DataFrame:
    return words.word_counts(spread(t.documents.select("text")), "text")


@query(
    "letter_counts",
    """SELECT substr(word, 1, 1) AS letter, count(*) AS amount
        FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY letter""",
)
def letter_counts(t: Tables) -> DataFrame:
    return words.letter_counts(words.word_counts(spread(t.documents.select("text")), "text"))


@query(
    "employees_per_postal_code",
    """SELECT n_name AS place, count(c_custkey) AS people FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
)
def employees_per_postal_code(t: Tables) -> DataFrame:
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("person_id"), F.col("n_name").alias("place")
    )
    return sales.people_per_place(t.customer, places, "c_custkey", "person_id", "place")


# --- the mart as it is stored --------------------------------------------------------------------


@query(
    "fact_ride_stored",
    with_tables(
        FACT_TABLES,
        FACTS.replace("ride_distance,", "CAST(CAST(ride_distance AS DECIMAL(18,3)) AS DECIMAL(10,2)) AS ride_distance,", 1),
        measures=MEASURES,
    ),
)
def fact_ride_stored(t: Tables) -> DataFrame:
    """The fact with its stored types, written and read back."""
    path = scratch_dir(t.spark, "fact-stored")
    write_parquet(facts.as_stored(fact_rides(t)), path)
    return read_parquet(t.spark, path)


NO_WEATHER = "SELECT '' AS zipcode, TIMESTAMP '2000-01-01 00:00:00' AS weather_hour, '' AS weather_type WHERE FALSE"


@query(
    "fact_ride_without_weather",
    with_tables(FACT_TABLES.replace(" weather_hourly", ""), FACTS, weather_hourly=NO_WEATHER, measures=MEASURES),
)
def fact_ride_without_weather(t: Tables) -> DataFrame:
    """No weather was ever loaded: every ride gets the unknown member."""
    schema = dimensions.weather_hourly(t.weather_documents).schema
    hourly = read_optional(t.spark, scratch_dir(t.spark, "no-weather"), schema)
    opened = facts.RideDimensions(t.dim_date, dimensions.weather_members(t.spark), t.dim_user, t.dim_lock, t.lock_places, hourly)
    opened = opened.counted()
    return facts.ride_facts(measured(t, t.order_rides, opened.places), opened)


MART = ("dim_date", "dim_user", "dim_lock", "weather_members", "weather_hourly")


@query(
    "write_whole_mart",
    with_tables(
        FACT_TABLES + " vehicles lots bike_types",
        " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS total FROM {name}" for name in MART)
        + " UNION ALL SELECT 'dim_vehicle', count(*) FROM vehicles JOIN lots USING (lot_id) JOIN bike_types USING (bike_type_id)"
        + " UNION ALL SELECT 'fact_ride', count(*) FROM facts",
        measures=MEASURES,
        facts=FACTS,
    ),
)
def write_whole_mart(t: Tables) -> DataFrame:
    """Dimensions, staged weather and fact in one export; the counts come from the files."""
    opened = ride_dimensions(t)
    fact = facts.ride_facts(measured(t, t.order_rides, opened.places), opened)
    tables = {
        "dim_date": t.dim_date,
        "dim_user": t.dim_user,
        "dim_vehicle": dimensions.vehicles(t.vehicles, t.lots, t.bike_types),
        "dim_lock": t.dim_lock,
        "weather_members": dimensions.weather_members(t.spark),
        "weather_hourly": opened.hourly_weather,
        "fact_ride": facts.as_stored(fact),
    }
    folder = scratch_dir(t.spark, "mart")
    counts = []
    for name in write_all(tables, folder):
        counts.append(read_parquet(t.spark, f"{folder}/{name}").agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("name"), "total"))
    return reduce(DataFrame.unionByName, counts)


# --- growing data --------------------------------------------------------------------------------


@query(
    "distinct_users_by_month",
    "SELECT date_trunc('month', ts)::DATE AS month, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def distinct_users_by_month(t: Tables) -> DataFrame:
    """Different users of every month from stored bitmaps of days; the second load reads none of the first one's events."""
    events = t.events.select(F.to_date("ts").alias("day"), "user_id")
    half = F.col("day") < F.lit("2024-01-15").cast("date")
    first = bitmaps(events.where(half), ["day"], "user_id")
    stored = BatchTable(t.spark, scratch_dir(t.spark, "user-days"), first.schema)
    stored.load("first half", first)
    stored.load("second half", bitmaps(events.where(~half), ["day"], "user_id"))
    return counted(stored.read().withColumn("month", F.trunc("day", "month")), ["month"], "users")


@query(
    "weather_documents_mixed",
    with_tables(
        "weather",
        """SELECT event_id, CASE WHEN event_id % 5 = 3 THEN NULL ELSE zipcode END AS zipcode,
            CASE WHEN event_id % 5 IN (3, 4) THEN NULL ELSE epoch END AS epoch,
            CASE WHEN event_id % 5 = 3 THEN NULL ELSE condition END AS condition,
            CASE WHEN event_id % 5 IN (2, 3) THEN NULL ELSE kelvin END AS kelvin,
            CAST(CASE WHEN event_id % 5 = 1 THEN 40 END AS INT) AS humidity,
            CASE event_id % 5 WHEN 2 THEN 'kelvin: not a double' WHEN 3 THEN 'unreadable' WHEN 4 THEN 'epoch: missing' ELSE '' END AS faults
        FROM weather""",
    ),
)
def weather_documents_mixed(t: Tables) -> DataFrame:
    """Documents of the old shape, the new one, and three kinds of broken ones, each with what is wrong with it."""
    old = lambda *dropped: F.to_json(
        F.struct(
            F.col("zipcode").alias("zipCode"),
            F.array(F.struct(F.col("condition").alias("main"))).alias("weather"),
            F.struct((F.lit("warm") if "kelvin" in dropped else F.col("kelvin")).alias("temp")).alias("main"),
            *([] if "epoch" in dropped else [F.col("epoch").alias("dt")]),
        )
    )
    new = F.to_json(
        F.struct(
            F.struct(F.col("zipcode").alias("zip")).alias("place"),
            F.col("condition").alias("sky"),
            F.struct(F.col("kelvin").alias("kelvin")).alias("temperature"),
            F.col("epoch").cast("string").alias("observed"),
            F.lit(40).alias("humidity"),
        )
    )
    shape = F.col("event_id") % 5
    text = F.when(shape == 1, new).when(shape == 2, old("kelvin")).when(shape == 3, F.lit('{"zipCode": ')).when(shape == 4, old("epoch")).otherwise(old())
    documents = variants.typed_documents(t.weather.select("event_id", text.alias("value")), "value", variants.WEATHER_FIELDS)
    return documents.withColumn("faults", F.array_join("faults", ", ")).drop("value")
