"""The mart's source tables, bound to the test tables.

Every binding exists twice: as a DataFrame on :class:`Tables` and as a SQL common table expression of
the same name in :data:`CTE`, from which :func:`with_tables` puts statements together.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelhouse.operators import scd2
from wheelhouse.plans import dimensions
from wheelhouse.sources import generated

SUBSCRIPTION_TYPES = [(1, "1-URGENT"), (2, "2-HIGH"), (3, "3-MEDIUM"), (4, "4-NOT SPECIFIED"), (5, "5-LOW")]
FIRST_WEATHER_DAY = 788_918_400  # 1995-01-01 00:00 UTC in epoch seconds
REP_START, REP_RUN = "1996-01-01 00:00:00", "1998-06-01 00:00:00"
MOVED_KEYS = 1_000_000_000

USER_SPEC = scd2.Type2(
    key="user_id", tracked=("street", "number", "zipcode", "city", "country_code"), surrogate="user_sk"
)
REP_SPEC = scd2.Type2(
    key="salesrep_id",
    tracked=("name", "office"),
    end_of_time="2100-12-12 00:00:00",
    hash_policy="concat",
    surrogate="salesrep_sk",
    start="scd_start",
    end="scd_end",
)


class Tables:
    """The tables of one folder and the bindings built on them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """A table; its files are listed once."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(self.path(name))
        return self._opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.read(name)
        raise AttributeError(name)

    @cached_property
    def rides(self) -> DataFrame:
        """One ride per line item; many rides per subscription and no ride id."""
        minutes = F.col("l_quantity").cast("int") - 5
        later = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))
        line = F.col("l_linenumber")
        return self.lineitem.select(
            F.col("l_orderkey").alias("subscription_id"),
            F.col("l_partkey").alias("vehicle_id"),
            F.col("l_suppkey").alias("start_lock_id"),
            F.when(line != 5, F.col("l_partkey") % 120).alias("end_lock_id"),
            F.col("l_shipdate").alias("start_time"),
            F.when(line != 7, later).alias("end_time"),
            _offset(51.15, "l_suppkey", 100).alias("start_lat"),
            _offset(4.35, "l_suppkey", 37).alias("start_lon"),
            _offset(51.15, "l_partkey", 100).alias("end_lat"),
            _offset(4.35, "l_partkey", 37).alias("end_lon"),
        )

    @cached_property
    def order_rides(self) -> DataFrame:
        """One ride per order, with a unique ride id."""
        key = F.col("o_orderkey")
        minutes = (key % 50).cast("int") - 5

        def partly(column: Column) -> Column:
            return F.when(key % 4 != 0, column)

        return self.orders.select(
            key.alias("ride_id"),
            F.when(key % 13 != 0, key).alias("subscription_id"),
            (key % 2000).alias("vehicle_id"),
            F.when(key % 9 != 0, key % 100).alias("start_lock_id"),
            F.when(key % 5 != 0, key % 120).alias("end_lock_id"),
            F.col("o_orderdate").alias("start_time"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))).alias("end_time"),
            partly(_offset(51.15, "o_orderkey", 100)).alias("start_lat"),
            partly(_offset(4.35, "o_orderkey", 37)).alias("start_lon"),
            partly(_offset(51.15, "o_orderkey", 90)).alias("end_lat"),
            partly(_offset(4.35, "o_orderkey", 41)).alias("end_lon"),
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("subscription_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("valid_from"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("subscription_type_id"),
        )

    @cached_property
    def subscription_types(self) -> DataFrame:
        return generated.inline_rows(self.spark, SUBSCRIPTION_TYPES, "subscription_type_id int, description string")

    @cached_property
    def users(self) -> DataFrame:
        home = self.nation.select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country_code"),
        )
        return self.customer.join(home, "c_nationkey").select(
            F.col("c_custkey").alias("user_id"),
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
            F.col("c_name").alias("street"),
            F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey").cast("string")).alias("number"),
            F.col("c_mktsegment").alias("zipcode"),
            "city",
            "country_code",
        )

    @cached_property
    def bike_types(self) -> DataFrame:
        kind = F.col("p_size") % 4 + 1
        named = self.part.groupBy(kind.alias("bike_type_id")).agg(F.min(F.substring_index("p_type", " ", -1)).alias("maker"))
        return named.select("bike_type_id", F.concat_ws("-", "maker", "bike_type_id").alias("description"))

    @cached_property
    def lots(self) -> DataFrame:
        return self.part.select(
            F.col("p_size").alias("lot_id"), (F.col("p_size") % 4 + 1).alias("bike_type_id")
        ).distinct()

    @cached_property
    def vehicles(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("vehicle_id"), F.col("p_name").alias("serial_number"), F.col("p_size").alias("lot_id")
        )

    @cached_property
    def stations(self) -> DataFrame:
        key = F.col("n_nationkey")
        x, y = ((F.lit(base) + key) for base in (51000, 4000))
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            key.alias("station_id"),
            F.lpad(key.cast("string"), 3, "0").alias("station_nr"),
            F.col("n_name").alias("street"),
            F.when(key % 3 != 0, key.cast("string")).alias("number"),
            (key + 2000).cast("string").alias("zipcode"),
            F.col("r_name").alias("district"),
            F.concat(F.lit("("), x.cast("string"), F.lit(","), y.cast("string"), F.lit(")")).alias("gps_coord"),
            (F.lit(51.15) + key / F.lit(1000.0)).alias("lat"),
            (F.lit(4.35) + key / F.lit(500.0)).alias("lon"),
        )

    @cached_property
    def locks(self) -> DataFrame:
        return self.supplier.select(F.col("s_suppkey").alias("lock_id"), F.col("s_nationkey").alias("station_id"))

    @cached_property
    def weather(self) -> DataFrame:
        """Weather reports: place, moment, condition and temperature."""
        kind, event = F.col("event_type"), F.col("event_id")
        condition = (
            F.when(kind == "view", "Clear")
            .when(kind == "click", "Clouds")
            .when(kind == "purchase", "Rain")
            .when(kind == "signup", "Snow")
            .otherwise("light rain")
        )
        return self.events.select(
            "event_id",
            (F.col("user_id") % 25 + 2000).cast("string").alias("zipcode"),
            (F.lit(FIRST_WEATHER_DAY) + event % 300 * 86400 + event % 3600).cast("long").alias("epoch"),
            condition.alias("condition"),
            (F.col("value") - F.lit(10.0) + F.lit(273.15)).alias("kelvin"),
        )

    @cached_property
    def weather_documents(self) -> DataFrame:
        """The same reports as JSON text in column ``value``."""
        entry = F.struct(
            F.lit(500).alias("id"),
            F.col("condition").alias("main"),
            F.lower("condition").alias("description"),
            F.lit("10d").alias("icon"),
        )
        document = F.struct(
            F.col("zipcode").alias("zipCode"),
            F.struct(F.lit(4.4).alias("lon"), F.lit(51.2).alias("lat")).alias("coord"),
            F.array(entry).alias("weather"),
            F.lit("stations").alias("base"),
            F.struct(F.col("kelvin").alias("temp"), F.lit(1013).alias("pressure")).alias("main"),
            F.col("epoch").alias("dt"),
        )
        return self.weather.select("event_id", F.to_json(document).alias("value"))

    @cached_property
    def sales(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("salesrep_id"),
            F.col("o_totalprice").alias("amount"),
        )

    @cached_property
    def late_sales(self) -> DataFrame:
        """A later extract of the sales: corrected amounts, and orders under keys not seen before."""
        moved = F.when(F.col("o_orderstatus") == "P", F.lit(MOVED_KEYS)).otherwise(F.lit(0))
        raised = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1.0)).otherwise(F.lit(0.0))
        return self.orders.select(
            (F.col("o_orderkey") + moved).alias("order_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("salesrep_id"),
            (F.col("o_totalprice") + raised).alias("amount"),
        )

    @cached_property
    def salesreps(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("salesrep_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("office")
        )

    @cached_property
    def late_salesreps(self) -> DataFrame:
        """A later extract: some have moved office, some left, and some are new."""
        balance = F.col("c_acctbal")
        key = F.when(balance > 9000, F.col("c_custkey") + MOVED_KEYS).otherwise(F.col("c_custkey"))
        return self.customer.select(
            key.alias("salesrep_id"),
            F.col("c_name").alias("name"),
            F.when(balance < 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")).alias("office"),
        )

    @cached_property
    def dim_salesrep_initial(self) -> DataFrame:
        return scd2.initial_load(self.salesreps, REP_SPEC, REP_START)

    @cached_property
    def dim_salesrep(self) -> DataFrame:
        """The sales reps after one incremental run."""
        return scd2.apply_snapshot(self.dim_salesrep_initial, self.late_salesreps, REP_SPEC, REP_RUN)

    @cached_property
    def dim_user(self) -> DataFrame:
        return scd2.initial_load(self.users, USER_SPEC, REP_START)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.ride_date_attributes(generated.dates_covering(self.orders, "o_orderdate"))

    @cached_property
    def calendar(self) -> DataFrame:
        return dimensions.calendar_attributes(generated.dates_covering(self.orders, "o_orderdate"))

    @cached_property
    def dim_lock(self) -> DataFrame:
        return dimensions.locks(self.locks, self.stations)

    @cached_property
    def lock_places(self) -> DataFrame:
        return dimensions.lock_places(self.locks, self.stations)


BASE_TABLES = frozenset(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations".split()
)


def _offset(base: float, key: str, steps: int) -> Column:
    return F.lit(base) + F.col(key) % steps / F.lit(1000.0)


CTE = {
    "rides": """SELECT l_orderkey AS subscription_id, l_partkey AS vehicle_id, l_suppkey AS start_lock_id,
        CASE WHEN l_linenumber <> 5 THEN l_partkey % 120 END AS end_lock_id, l_shipdate AS start_time,
        CASE WHEN l_linenumber <> 7 THEN l_shipdate + to_minutes(CAST(l_quantity AS INT) - 5) END AS end_time,
        51.15::DOUBLE + (l_suppkey % 100) / 1000.0::DOUBLE AS start_lat,
        4.35::DOUBLE + (l_suppkey % 37) / 1000.0::DOUBLE AS start_lon,
        51.15::DOUBLE + (l_partkey % 100) / 1000.0::DOUBLE AS end_lat,
        4.35::DOUBLE + (l_partkey % 37) / 1000.0::DOUBLE AS end_lon FROM lineitem""",
    "order_rides": """SELECT o_orderkey AS ride_id, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS subscription_id,
        o_orderkey % 2000 AS vehicle_id, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 100 END AS start_lock_id,
        CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 120 END AS end_lock_id, o_orderdate AS start_time,
        o_orderdate + to_minutes(CAST(o_orderkey % 50 AS INT) - 5) AS end_time,
        CASE WHEN o_orderkey % 4 <> 0 THEN 51.15::DOUBLE + (o_orderkey % 100) / 1000.0::DOUBLE END AS start_lat,
        CASE WHEN o_orderkey % 4 <> 0 THEN 4.35::DOUBLE + (o_orderkey % 37) / 1000.0::DOUBLE END AS start_lon,
        CASE WHEN o_orderkey % 4 <> 0 THEN 51.15::DOUBLE + (o_orderkey % 90) / 1000.0::DOUBLE END AS end_lat,
        CASE WHEN o_orderkey % 4 <> 0 THEN 4.35::DOUBLE + (o_orderkey % 41) / 1000.0::DOUBLE END AS end_lon
        FROM orders""",
    "subscriptions": """SELECT o_orderkey AS subscription_id, o_custkey AS user_id, o_orderdate AS valid_from,
        CAST(substr(o_orderpriority, 1, 1) AS INT) AS subscription_type_id FROM orders""",
    "subscription_types": """SELECT * FROM (VALUES (1, '1-URGENT'), (2, '2-HIGH'), (3, '3-MEDIUM'),
        (4, '4-NOT SPECIFIED'), (5, '5-LOW')) v(subscription_type_id, description)""",
    "users": """SELECT c_custkey AS user_id, lower(c_name) || '@example.org' AS email, c_name AS street,
        CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS number, c_mktsegment AS zipcode,
        n_name AS city, 'R' || CAST(n_regionkey AS VARCHAR) AS country_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "bike_types": """SELECT p_size % 4 + 1 AS bike_type_id,
        min(regexp_extract(p_type, '[^ ]*$')) || '-' || CAST(p_size % 4 + 1 AS VARCHAR) AS description
        FROM part GROUP BY p_size % 4 + 1""",
    "lots": "SELECT DISTINCT p_size AS lot_id, p_size % 4 + 1 AS bike_type_id FROM part",
    "vehicles": "SELECT p_partkey AS vehicle_id, p_name AS serial_number, p_size AS lot_id FROM part",
    "stations": """SELECT n_nationkey AS station_id, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS station_nr,
        n_name AS street, CASE WHEN n_nationkey % 3 <> 0 THEN CAST(n_nationkey AS VARCHAR) END AS number,
        CAST(n_nationkey + 2000 AS VARCHAR) AS zipcode, r_name AS district,
        '(' || CAST(51000 + n_nationkey AS VARCHAR) || ',' || CAST(4000 + n_nationkey AS VARCHAR) || ')' AS gps_coord,
        51.15::DOUBLE + n_nationkey / 1000.0::DOUBLE AS lat, 4.35::DOUBLE + n_nationkey / 500.0::DOUBLE AS lon
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "locks": "SELECT s_suppkey AS lock_id, s_nationkey AS station_id FROM supplier",
    "weather": f"""SELECT event_id, CAST(user_id % 25 + 2000 AS VARCHAR) AS zipcode,
        {FIRST_WEATHER_DAY} + event_id % 300 * 86400 + event_id % 3600 AS epoch,
        CASE event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Clouds' WHEN 'purchase' THEN 'Rain'
             WHEN 'signup' THEN 'Snow' ELSE 'light rain' END AS condition,
        value - 10.0::DOUBLE + 273.15::DOUBLE AS kelvin FROM events""",
    "sales": """SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_custkey AS salesrep_id,
        o_totalprice AS amount FROM orders""",
    "late_sales": f"""SELECT o_orderkey + CASE WHEN o_orderstatus = 'P' THEN {MOVED_KEYS} ELSE 0 END AS order_id,
        o_orderdate AS order_date, o_custkey AS salesrep_id,
        o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS amount
        FROM orders""",
    "salesreps": "SELECT c_custkey AS salesrep_id, c_name AS name, c_mktsegment AS office FROM customer",
    "late_salesreps": f"""SELECT CASE WHEN c_acctbal > 9000 THEN c_custkey + {MOVED_KEYS} ELSE c_custkey END AS salesrep_id,
        c_name AS name, CASE WHEN c_acctbal < 0 THEN 'CHANGED' ELSE c_mktsegment END AS office FROM customer""",
    "dim_salesrep_initial": f"""SELECT md5(CAST(salesrep_id AS VARCHAR) || '|{REP_START}') AS salesrep_sk, salesrep_id,
        name, office, TIMESTAMP '{REP_START}' AS scd_start, TIMESTAMP '2100-12-12 00:00:00' AS scd_end,
        TRUE AS is_current, md5(name || office) AS md5 FROM salesreps""",
    # Written as the three cases of a snapshot load, each from its own condition.
    "dim_salesrep": f"""SELECT d.salesrep_sk, d.salesrep_id, d.name, d.office, d.scd_start,
            CASE WHEN s.salesrep_id IS NOT NULL AND md5(s.name || s.office) <> d.md5 THEN TIMESTAMP '{REP_RUN}'
                 ELSE d.scd_end END AS scd_end,
            NOT (s.salesrep_id IS NOT NULL AND md5(s.name || s.office) <> d.md5) AS is_current, d.md5
        FROM dim_salesrep_initial d LEFT JOIN late_salesreps s ON s.salesrep_id = d.salesrep_id
        UNION ALL
        SELECT md5(CAST(s.salesrep_id AS VARCHAR) || '|{REP_RUN}'), s.salesrep_id, s.name, s.office,
            TIMESTAMP '{REP_RUN}', TIMESTAMP '2100-12-12 00:00:00', TRUE, md5(s.name || s.office)
        FROM late_salesreps s
        WHERE NOT EXISTS (SELECT 1 FROM dim_salesrep_initial d
                          WHERE d.salesrep_id = s.salesrep_id AND d.md5 = md5(s.name || s.office))""",
    "dim_user": f"""SELECT md5(CAST(user_id AS VARCHAR) || '|{REP_START}') AS user_sk, user_id, street, number, zipcode,
        city, country_code, TIMESTAMP '{REP_START}' AS start_date, TIMESTAMP '2100-12-31 00:00:00' AS end_date,
        TRUE AS is_current, md5(concat_ws('|', coalesce(street, ''), coalesce(number, ''), coalesce(zipcode, ''),
        coalesce(city, ''), coalesce(country_code, ''))) AS md5 FROM users""",
    "days": """SELECT CAST(origin AS DATE) AS origin, CAST(unnest(generate_series(origin, until, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT date_trunc('year', min(o_orderdate)) AS origin,
                     CAST(make_date(CAST(year(max(o_orderdate)) AS INT), 12, 31) AS TIMESTAMP) AS until FROM orders)""",
    "dim_date": """SELECT CAST(date_diff('day', origin, date) + 1 AS INT) AS date_sk, date, CAST(year(date) AS INT) AS year,
        CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month_nr, monthname(date) AS month_name,
        CAST(day(date) AS INT) AS day_nr, dayname(date) AS day_name, isodow(date) < 6 AS is_weekday FROM days""",
    "calendar": """SELECT CAST(date_diff('day', origin, date) AS INT) AS date_sk,
        CAST(strftime(date, '%Y%m%d') AS INT) AS date_int, date AS calendar_date,
        CAST(year(date) AS INT) AS calendar_year, monthname(date) AS calendar_month,
        CAST(month(date) AS INT) AS month_of_year, dayname(date) AS calendar_day,
        CAST(dayofweek(date) + 1 AS INT) AS day_of_week, CAST(isodow(date) AS INT) AS day_of_week_start_monday,
        CASE WHEN isodow(date) < 6 THEN 'Y' ELSE 'N' END AS is_week_day, CAST(day(date) AS INT) AS day_of_month,
        CASE WHEN day(date + INTERVAL 1 DAY) = 1 THEN 'Y' ELSE 'N' END AS is_last_day_of_month,
        CAST(dayofyear(date) AS INT) AS day_of_year, CAST(weekofyear(date) AS INT) AS week_of_year_iso,
        CAST(quarter(date) AS INT) AS quarter_of_year FROM days""",
    "weather_members": """SELECT * FROM (VALUES (1, 'Pleasant'), (2, 'Unpleasant'), (3, 'Neutral'), (4, 'Unknown'))
        v(weather_id, weather_type)""",
    "weather_hourly": """SELECT zipcode, weather_hour, CASE WHEN condition = 'Rain' OR condition LIKE '%rain%' THEN 'Unpleasant'
            WHEN condition = 'Clear' AND kelvin > 288.15::DOUBLE THEN 'Pleasant' ELSE 'Neutral' END AS weather_type
        FROM (SELECT *, row_number() OVER (PARTITION BY zipcode, weather_hour
                                           ORDER BY epoch DESC, kelvin DESC, condition DESC) AS rn
              FROM (SELECT *, date_trunc('hour', make_timestamp(epoch * 1000000)) AS weather_hour FROM weather))
        WHERE rn = 1""",
    "dim_lock": """SELECT lock_id, station_id, station_nr, street, number, zipcode, district, gps_coord
        FROM locks JOIN stations USING (station_id)
        UNION ALL SELECT -1, NULL, 'no lock', NULL, NULL, NULL, NULL, NULL""",
    "lock_places": "SELECT lock_id, zipcode, lat, lon FROM locks JOIN stations USING (station_id)",
}

_NEEDS = {
    "dim_salesrep_initial": ["salesreps"],
    "dim_salesrep": ["salesreps", "late_salesreps", "dim_salesrep_initial"],
    "dim_user": ["users"],
    "dim_date": ["days"],
    "calendar": ["days"],
    "weather_hourly": ["weather"],
    "dim_lock": ["locks", "stations"],
    "lock_places": ["locks", "stations"],
}


def with_tables(names: str, body: str, **extra: str) -> str:
    """``body`` after a WITH clause for the named bindings and what they need, then ``extra`` ones."""
    order: list[str] = []
    for name in names.split():
        for part in (*_NEEDS.get(name, ()), name):
            if part not in order:
                order.append(part)
    parts = [f"{name} AS ({CTE[name]})" for name in order] + [f"{name} AS ({sql})" for name, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
