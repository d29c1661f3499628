"""Joins, aggregations, keys, sorts, set operations and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.catalog.bindings import Tables, with_tables
from wheelhouse.catalog.registry import query
from wheelhouse.functions import dates, weather
from wheelhouse.operators import hot_keys, joins, keys, limits, ordered, quality
from wheelhouse.operators.layout import spread
from wheelhouse.plans import dimensions, facts, rides, sales, words
from wheelhouse.session import scratch_dir
from wheelhouse.sinks.files import staged
from wheelhouse.sources.files import read_csv

# --- joins ---------------------------------------------------------------------------------------


@query(
    "join_inner_chain",
    with_tables(
        "rides subscriptions users",
        """SELECT u.user_id, u.city, count(*) AS rides, min(r.start_time) AS first_start
        FROM rides r JOIN subscriptions s USING (subscription_id) JOIN users u ON u.user_id = s.user_id
        GROUP BY u.user_id, u.city""",
    ),
)
def join_inner_chain(t: Tables) -> DataFrame:
    """Rides are counted per subscription before they are joined, so a hot one is one row per task by then."""
    counted = t.rides.groupBy("subscription_id").agg(F.count(F.lit(1)).alias("rides"), F.min("start_time").alias("first_start"))
    chain = counted.join(t.subscriptions, "subscription_id").join(t.users, "user_id")
    return chain.groupBy("user_id", "city").agg(F.sum("rides").alias("rides"), F.min("first_start").alias("first_start"))


@query(
    "join_using",
    with_tables(
        "order_rides subscriptions vehicles",
        """SELECT vehicle_id, ride_id, subscription_id, user_id, serial_number FROM order_rides
        JOIN vehicles USING (vehicle_id) JOIN subscriptions USING (subscription_id)""",
    ),
)
def join_using(t: Tables) -> DataFrame:
    joined = t.order_rides.join(t.vehicles, "vehicle_id").join(t.subscriptions, "subscription_id")
    return joined.select("vehicle_id", "ride_id", "subscription_id", "user_id", "serial_number")


@query(
    "join_self_role",
    with_tables(
        "order_rides locks stations",
        """SELECT ride_id, a.station_id AS start_station, sa.street AS start_street,
        b.station_id AS end_station, sb.street AS end_street
        FROM order_rides JOIN locks a ON a.lock_id = start_lock_id JOIN stations sa ON sa.station_id = a.station_id
        JOIN locks b ON b.lock_id = end_lock_id JOIN stations sb ON sb.station_id = b.station_id""",
    ),
)
def join_self_role(t: Tables) -> DataFrame:
    (placed,) = joins.sized(t.locks.join(t.stations, "station_id"))
    a, b = placed.alias("a"), placed.alias("b")
    joined = t.order_rides.join(a, F.col("start_lock_id") == F.col("a.lock_id")).join(
        b, F.col("end_lock_id") == F.col("b.lock_id")
    )
    return joined.select(
        "ride_id",
        F.col("a.station_id").alias("start_station"),
        F.col("a.street").alias("start_street"),
        F.col("b.station_id").alias("end_station"),
        F.col("b.street").alias("end_street"),
    )


@query(
    "join_left_lookup",
    with_tables(
        "order_rides locks",
        "SELECT ride_id, end_lock_id, station_id FROM order_rides LEFT JOIN locks ON lock_id = end_lock_id",
    ),
)
def join_left_lookup(t: Tables) -> DataFrame:
    found = joins.lookup(t.order_rides, t.locks, {"end_lock_id": "lock_id"}, {"station_id": "station_id"})
    return found.select("ride_id", "end_lock_id", "station_id")


@query(
    "join_left_default_member",
    with_tables(
        "order_rides dim_lock",
        """SELECT ride_id, coalesce(d.lock_id, -1) AS end_lock_sk FROM order_rides r
        LEFT JOIN dim_lock d ON d.lock_id = r.end_lock_id""",
    ),
)
def join_left_default_member(t: Tables) -> DataFrame:
    (dim_lock,) = joins.sized(t.dim_lock.select("lock_id"))
    found = joins.lookup(t.order_rides, dim_lock, {"end_lock_id": "lock_id"}, {"end_lock_sk": "lock_id"}, default=-1)
    return found.select("ride_id", "end_lock_sk")


@query(
    "join_left_residual",
    with_tables(
        "sales dim_salesrep",
        """SELECT order_id, s.salesrep_id, salesrep_sk, office FROM sales s
        LEFT JOIN dim_salesrep d ON d.salesrep_id = s.salesrep_id AND d.is_current""",
    ),
)
def join_left_residual(t: Tables) -> DataFrame:
    take = {"salesrep_sk": "salesrep_sk", "office": "office"}
    found = joins.lookup(t.sales, t.dim_salesrep, {"salesrep_id": "salesrep_id"}, take, only=F.col("is_current"))
    return found.select("order_id", "salesrep_id", "salesrep_sk", "office")


ASOF_SQL = """SELECT order_id, s.salesrep_id, order_date, salesrep_sk, office FROM sales s
        LEFT JOIN dim_salesrep d ON d.salesrep_id = s.salesrep_id
        AND s.order_date > d.scd_start AND s.order_date <= d.scd_end"""


@query("join_asof_validity", with_tables("sales dim_salesrep", ASOF_SQL))
def join_asof_validity(t: Tables) -> DataFrame:
    take = {"salesrep_sk": "salesrep_sk", "office": "office"}
    found = joins.valid_at(
        t.sales, t.dim_salesrep, "salesrep_id", "salesrep_id", "order_date", "scd_start", "scd_end", take
    )
    return found.select("order_id", "salesrep_id", "order_date", "salesrep_sk", "office")


LONG_HISTORIES = """WITH months AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS starts,
            round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1, 2),
        visits AS (SELECT event_id, {who} AS user_id, TIMESTAMP '1995-01-01 12:00:00' + to_days(CAST(event_id % 2400 AS INT)) AS seen_at
                   FROM events)
        SELECT event_id, user_id, seen_at, spent FROM visits
        LEFT JOIN months ON customer = user_id AND seen_at > starts AND seen_at <= starts + INTERVAL 1 MONTH"""


def _months(t: Tables) -> DataFrame:
    """What every customer spent, as monthly versions."""
    month = F.trunc("o_orderdate", "month")
    months = t.orders.groupBy(F.col("o_custkey").alias("customer"), month.alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    return months.select(
        "customer",
        "spent",
        F.col("month").cast("timestamp_ntz").alias("starts"),
        F.add_months("month", 1).cast("timestamp_ntz").alias("ends"),
    )


def _visits(t: Tables, who: Column) -> DataFrame:
    day = F.make_dt_interval((F.col("event_id") % 2400).cast("int"))
    noon = F.lit("1995-01-01 12:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", who.alias("user_id"), (noon + day).alias("seen_at"))


@query("join_asof_long_histories", LONG_HISTORIES.format(who="user_id"))
def join_asof_long_histories(t: Tables) -> DataFrame:
    """The same lookup into monthly versions, in one ordered pass over both."""
    return ordered.asof_ordered(
        _visits(t, F.col("user_id")), _months(t), "user_id", "customer", "seen_at", "starts", "ends", {"spent": "spent"}
    )


SKEWED_WHO = "CASE WHEN event_id % 5 < 2 THEN 1 WHEN event_id % 5 = 2 THEN NULL ELSE user_id END"


@query("join_asof_hot_key", LONG_HISTORIES.format(who=SKEWED_WHO))
def join_asof_hot_key(t: Tables) -> DataFrame:
    """Two facts in five belong to one customer and one in five to nobody: that customer's time is cut into slices."""
    visits = _visits(t, F.expr(SKEWED_WHO))
    take = {"spent": "spent"}
    return ordered.asof_ordered(visits, _months(t), "user_id", "customer", "seen_at", "starts", "ends", take, min_rows=100)


@query(
    "join_left_hot_keys",
    """SELECT l_orderkey, l_linenumber, who AS o_orderkey, o_orderpriority FROM (
        SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 < 2 THEN 1 WHEN l_partkey % 5 = 2 THEN NULL ELSE l_orderkey END AS who
        FROM lineitem) LEFT JOIN orders ON o_orderkey = who""",
)
def join_left_hot_keys(t: Tables) -> DataFrame:
    """A lookup in which two facts in five share one key and one in five has none; the dimension is not broadcast."""
    who = F.expr("CASE WHEN l_partkey % 5 < 2 THEN 1 WHEN l_partkey % 5 = 2 THEN NULL ELSE l_orderkey END")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", who.alias("who"))
    found = hot_keys.lookup_hot(rows, t.orders, {"who": "o_orderkey"}, {"o_orderpriority": "o_orderpriority"})
    return found.withColumnRenamed("who", "o_orderkey")


@query(
    "join_on_derived_keys",
    with_tables(
        "order_rides lock_places weather_hourly weather_members",
        """SELECT ride_id, weather_id FROM order_rides LEFT JOIN lock_places p ON p.lock_id = start_lock_id
        LEFT JOIN weather_hourly w ON w.zipcode = coalesce(p.zipcode, '0000') AND w.weather_hour = date_trunc('hour', start_time)
        LEFT JOIN weather_members m ON m.weather_type = coalesce(w.weather_type, 'Unknown')""",
    ),
)
def join_on_derived_keys(t: Tables) -> DataFrame:
    places, reports = joins.sized(t.lock_places, staged(dimensions.weather_hourly(t.weather_documents), "weather"))
    placed = joins.lookup(t.order_rides, places, {"start_lock_id": "lock_id"}, {"zipcode": "zipcode"}).select(
        "ride_id",
        F.coalesce("zipcode", F.lit(facts.NO_POSTAL_CODE)).alias("zipcode"),
        dates.hour_of(F.col("start_time")).alias("hour"),
    )
    typed = joins.lookup(
        placed, reports, {"zipcode": "zipcode", "hour": "weather_hour"}, {"type": "weather_type"}, default=weather.UNKNOWN
    )
    members = dimensions.weather_members(t.spark)
    return joins.lookup(typed, members, {"type": "weather_type"}, {"weather_id": "weather_id"}, small=True).select(
        "ride_id", "weather_id"
    )


@query(
    "join_parquet_csv",
    "SELECT n_name, count(c_custkey) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def join_parquet_csv(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "customers-csv")
    t.customer.write.option("header", True).csv(path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    customers = read_csv(t.spark, path, schema)
    linked = customers.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return linked.groupBy("n_name").agg(F.count("c_custkey").alias("customers"))


@query(
    "join_antijoin_new_rows",
    with_tables(
        "late_salesreps salesreps",
        """SELECT s.* FROM late_salesreps s LEFT JOIN salesreps d ON d.salesrep_id = s.salesrep_id
        WHERE d.salesrep_id IS NULL""",
    ),
)
def join_antijoin_new_rows(t: Tables) -> DataFrame:
    return joins.unmatched(t.late_salesreps, t.salesreps, ["salesrep_id"])


@query(
    "join_fact_dims_inner",
    with_tables(
        "order_rides dim_date dim_lock",
        """SELECT ride_id, year, district FROM order_rides JOIN dim_date ON date = CAST(start_time AS DATE)
        JOIN dim_lock ON lock_id = end_lock_id""",
    ),
)
def join_fact_dims_inner(t: Tables) -> DataFrame:
    dated = t.order_rides.withColumn("date", F.to_date("start_time")).join(F.broadcast(t.dim_date), "date")
    (dim_lock,) = joins.sized(t.dim_lock.select("lock_id", "district"))
    return dated.join(dim_lock, F.col("end_lock_id") == F.col("lock_id")).select("ride_id", "year", "district")


# --- aggregations --------------------------------------------------------------------------------


@query(
    "agg_global_count",
    with_tables("rides", "SELECT count(*) AS all_rows, count(end_time) AS ended FROM rides"),
)
def agg_global_count(t: Tables) -> DataFrame:
    return t.rides.agg(F.count(F.lit(1)).alias("all_rows"), F.count("end_time").alias("ended"))


@query("agg_global_avg", "SELECT round(avg(c_acctbal), 4) AS avg_balance FROM customer")
def agg_global_avg(t: Tables) -> DataFrame:
    return t.customer.agg(F.round(F.avg("c_acctbal"), 4).alias("avg_balance"))


@query(
    "agg_group_max",
    "SELECT c_mktsegment AS department, max(c_acctbal) AS highest FROM customer GROUP BY c_mktsegment",
)
def agg_group_max(t: Tables) -> DataFrame:
    return t.customer.groupBy(F.col("c_mktsegment").alias("department")).agg(F.max("c_acctbal").alias("highest"))


@query(
    "agg_group_sum_by_expr",
    """SELECT CAST(year(o_orderdate) AS INT) AS year, round(sum(o_totalprice), 2) AS total FROM orders
        GROUP BY year(o_orderdate)""",
)
def agg_group_sum_by_expr(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "agg_group_count",
    "SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def agg_group_count(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "agg_group_by_alias",
    """SELECT CASE WHEN dayofweek(ts) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
        CAST(year(ts) AS INT) AS year, count(*) AS events FROM events GROUP BY day_type, year""",
)
def agg_group_by_alias(t: Tables) -> DataFrame:
    return t.events.groupBy(dates.day_type(F.col("ts")).alias("day_type"), F.year("ts").alias("year")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query(
    "agg_avg_of_avgs",
    """SELECT round(avg(a), 4) AS mean_of_means FROM (SELECT avg(value) AS a FROM events GROUP BY user_id)""",
)
def agg_avg_of_avgs(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.avg("value").alias("a")).agg(F.round(F.avg("a"), 4).alias("mean_of_means"))


@query(
    "agg_count_distinct",
    """SELECT CAST(year(o_orderdate) AS INT) AS year, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY year(o_orderdate)""",
)
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count_distinct("o_custkey").alias("customers"))


@query(
    "agg_conditional_ratio",
    """SELECT event_type, round(count(CASE WHEN value > 25 THEN 1 END) * 100.0::DOUBLE / count(*), 4) AS share
        FROM events GROUP BY event_type""",
)
def agg_conditional_ratio(t: Tables) -> DataFrame:
    share = F.count_if(F.col("value") > 25) * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return t.events.groupBy("event_type").agg(F.round(share, 4).alias("share"))


@query(
    "agg_sum_scaled",
    with_tables(
        "rides",
        """SELECT vehicle_id, round(sum(extract(epoch FROM end_time - start_time) / 3600.0::DOUBLE) * 10, 4) AS revenue
        FROM rides GROUP BY vehicle_id""",
    ),
)
def agg_sum_scaled(t: Tables) -> DataFrame:
    hours = dates.elapsed_hours(F.col("start_time"), F.col("end_time"))
    return t.rides.groupBy("vehicle_id").agg(F.round(F.sum(hours) * rides.HOURLY_RATE, 4).alias("revenue"))


@query(
    "agg_ratio_int_div",
    """SELECT event_type, CAST(count(*) // nullif(count(DISTINCT user_id), 0) AS BIGINT) AS per_user FROM events
        GROUP BY event_type""",
)
def agg_ratio_int_div(t: Tables) -> DataFrame:
    counted = t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")
    )
    return counted.select("event_type", F.expr("n div nullif(users, 0)").alias("per_user"))


@query(
    "agg_max_coalesce",
    """SELECT (SELECT coalesce(max(o_orderkey), 0) FROM orders) AS loaded,
        (SELECT coalesce(max(o_orderkey), 0) FROM orders WHERE o_totalprice < 0) AS nothing_loaded""",
)
def agg_max_coalesce(t: Tables) -> DataFrame:
    loaded = t.orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("loaded"))
    nothing = limits.high_watermark(t.orders.where(F.col("o_totalprice") < 0), "o_orderkey")
    return loaded.select("loaded", nothing.alias("nothing_loaded"))


WORDS_SQL = """SELECT word, count(*) AS amount FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
        WHERE word <> '' GROUP BY word"""


@query("agg_reduce_by_key", WORDS_SQL)
def agg_reduce_by_key(t: Tables) -> DataFrame:
    return words.word_counts(spread(t.documents.select("text")), "text")


@query(
    "agg_rollup_counts",
    f"SELECT substr(word, 1, 1) AS letter, CAST(sum(amount) AS BIGINT) AS amount FROM ({WORDS_SQL}) GROUP BY letter",
)
def agg_rollup_counts(t: Tables) -> DataFrame:
    return words.letter_counts(words.word_counts(spread(t.documents.select("text")), "text"))


@query(
    "agg_dim_revenue",
    """SELECT c_mktsegment AS office, round(sum(o_totalprice), 2) AS revenue FROM orders
        JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""",
)
def agg_dim_revenue(t: Tables) -> DataFrame:
    amounts = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("revenue_mv"))
    return sales.revenue_by(amounts, t.customer, "c_custkey", "c_mktsegment", "office")


# --- keys and histories --------------------------------------------------------------------------


@query("dedup_latest", with_tables("weather_hourly", "SELECT * FROM weather_hourly"))
def dedup_latest(t: Tables) -> DataFrame:
    return dimensions.weather_hourly(t.weather_documents)


@query(
    "dense_surrogate_key",
    "SELECT p_partkey AS vehicle_id, row_number() OVER (ORDER BY p_partkey) AS vehicle_sk FROM part",
)
def dense_surrogate_key(t: Tables) -> DataFrame:
    return keys.dense_keys(t.vehicles, "vehicle_id", "vehicle_sk")


@query(
    "scd2_chain_check",
    with_tables(
        "dim_salesrep",
        """SELECT salesrep_id, count(*) AS versions, count(*) FILTER (WHERE is_current) AS currents,
        count(*) FILTER (WHERE before IS NULL OR before <> scd_start) AS heads,
        count(*) FILTER (WHERE is_current) = 1 AND bool_and(scd_start < scd_end)
        AND count(*) FILTER (WHERE before IS NULL OR before <> scd_start) = 1 AS is_sound
        FROM (SELECT *, lag(scd_end) OVER (PARTITION BY salesrep_id ORDER BY scd_start) AS before FROM dim_salesrep)
        GROUP BY salesrep_id""",
    ),
)
def scd2_chain_check(t: Tables) -> DataFrame:
    return keys.version_chains(t.dim_salesrep, "salesrep_id", "scd_start", "scd_end", "is_current")


# --- sorts and limits ----------------------------------------------------------------------------


@query("sort_global", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier ORDER BY s_nationkey, s_acctbal DESC, s_suppkey")
def sort_global(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal").orderBy("s_nationkey", F.desc("s_acctbal"), "s_suppkey")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(t: Tables) -> DataFrame:
    return limits.first_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20)


@query(
    "limit_cap",
    with_tables("order_rides", "SELECT ride_id, start_time FROM order_rides ORDER BY ride_id LIMIT 15000"),
)
def limit_cap(t: Tables) -> DataFrame:
    return limits.first_rows(t.order_rides.select("ride_id", "start_time"), ["ride_id"], 15_000)


@query("keyset_batches", with_tables("order_rides", "SELECT ride_id, start_time FROM order_rides"))
def keyset_batches(t: Tables) -> DataFrame:
    """What is loaded plus everything above its last key is the whole table."""
    source = t.order_rides.select("ride_id", "start_time")
    border = limits.high_watermark(t.customer, "c_custkey")
    loaded = source.where(F.col("ride_id") <= border)
    return loaded.unionByName(limits.above_watermark(source, loaded, "ride_id", "ride_id"))


# --- set operations ------------------------------------------------------------------------------


@query(
    "union_all",
    with_tables(
        "order_rides",
        """SELECT start_lock_id AS lock_id FROM order_rides WHERE start_lock_id IS NOT NULL
        UNION ALL SELECT end_lock_id FROM order_rides WHERE end_lock_id IS NOT NULL""",
    ),
)
def union_all(t: Tables) -> DataFrame:
    sides = [t.order_rides.select(F.col(c).alias("lock_id")) for c in ("start_lock_id", "end_lock_id")]
    return sides[0].unionByName(sides[1]).where(F.col("lock_id").isNotNull())


@query("union_append_member", with_tables("dim_lock", "SELECT * FROM dim_lock"))
def union_append_member(t: Tables) -> DataFrame:
    return dimensions.locks(t.locks, t.stations)


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_nationkey").alias("nation"))
    return a.union(t.supplier.select("s_nationkey")).distinct()


@query(
    "distinct_rows",
    with_tables(
        "order_rides locks stations",
        """SELECT DISTINCT station_id, street, district FROM order_rides JOIN locks ON lock_id = start_lock_id
        JOIN stations USING (station_id)""",
    ),
)
def distinct_rows(t: Tables) -> DataFrame:
    used = t.order_rides.select(F.col("start_lock_id").alias("lock_id")).distinct()
    placed = used.join(t.locks, "lock_id").join(t.stations, "station_id")
    return placed.select("station_id", "street", "district").distinct()


# --- constraints ---------------------------------------------------------------------------------


@query(
    "fk_violations",
    with_tables(
        "rides locks",
        """SELECT end_lock_id AS key, count(*) AS row_count FROM rides r WHERE end_lock_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM locks l WHERE l.lock_id = r.end_lock_id) GROUP BY end_lock_id""",
    ),
)
def fk_violations(t: Tables) -> DataFrame:
    return quality.orphans(t.rides, "end_lock_id", t.locks, "lock_id")


@query(
    "pk_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
)
def pk_duplicates(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "not_null_violations",
    with_tables(
        "rides",
        """SELECT 'end_time' AS column_name, count(*) FILTER (WHERE end_time IS NULL) AS null_count FROM rides
        UNION ALL SELECT 'end_lock_id', count(*) FILTER (WHERE end_lock_id IS NULL) FROM rides
        UNION ALL SELECT 'start_time', count(*) FILTER (WHERE start_time IS NULL) FROM rides""",
    ),
)
def not_null_violations(t: Tables) -> DataFrame:
    return quality.null_counts(t.rides, ["end_time", "end_lock_id", "start_time"])


@query(
    "check_in_set",
    "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')",
)
def check_in_set(t: Tables) -> DataFrame:
    return quality.outside_set(t.events.select("event_id", "event_type"), "event_type", ["view", "click", "purchase"])


# The foreign keys of the operational schema (child, column, parent, key).
REFERENCES = [
    ("subscriptions", "user_id", "users", "user_id"),
    ("subscriptions", "subscription_type_id", "subscription_types", "subscription_type_id"),
    ("rides", "subscription_id", "subscriptions", "subscription_id"),
    ("rides", "vehicle_id", "vehicles", "vehicle_id"),
    ("rides", "start_lock_id", "locks", "lock_id"),
    ("rides", "end_lock_id", "locks", "lock_id"),
    ("vehicles", "lot_id", "lots", "lot_id"),
    ("lots", "bike_type_id", "bike_types", "bike_type_id"),
    ("locks", "station_id", "stations", "station_id"),
]


@query(
    "fk_violations_schema",
    with_tables(
        "subscriptions subscription_types users rides vehicles locks lots bike_types stations",
        " UNION ALL ".join(
            f"""SELECT '{child}.{column}' AS reference, count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows
            FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"""
            for child, column, parent, key in REFERENCES
        ),
    ),
)
def fk_violations_schema(t: Tables) -> DataFrame:
    return quality.reference_check(
        [(f"{child}.{column}", getattr(t, child), column, getattr(t, parent), key) for child, column, parent, key in REFERENCES]
    )
