"""UPDATE, DELETE, MERGE, history and slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.catalog.bindings import REP_RUN, REP_SPEC, USER_SPEC, Tables, with_tables
from wheelhouse.catalog.registry import query
from wheelhouse.functions import geo, hashing
from wheelhouse.operators import mutate, scd2
from wheelhouse.operators.mutate import incoming
from wheelhouse.operators.partitioned import PartitionedTable
from wheelhouse.session import scratch_dir
from wheelhouse.sources import versioned

# --- DML -----------------------------------------------------------------------------------------


@query(
    "update_where",
    """SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_brand = 'Brand#2' THEN p_size + 1 ELSE p_size END AS p_size,
        p_retailprice FROM part""",
)
def update_where(t: Tables) -> DataFrame:
    return mutate.update_where(t.part, F.col("p_brand") == "Brand#2", {"p_size": F.col("p_size") + 1})


@query(
    "delete_where",
    with_tables("order_rides", "SELECT ride_id, end_lock_id FROM order_rides WHERE (end_lock_id > 50) IS NOT TRUE"),
)
def delete_where(t: Tables) -> DataFrame:
    """Rows for which the predicate is unknown stay."""
    return mutate.delete_where(t.order_rides.select("ride_id", "end_lock_id"), F.col("end_lock_id") > 50)


MERGED = """SELECT t.order_id, t.order_date, t.salesrep_id, {amount} AS amount FROM sales t
        LEFT JOIN late_sales s ON s.order_id = t.order_id
        UNION ALL SELECT s.* FROM late_sales s WHERE NOT EXISTS (SELECT 1 FROM sales t WHERE t.order_id = s.order_id)"""


@query(
    "merge_upsert",
    with_tables(
        "sales late_sales", MERGED.format(amount="CASE WHEN s.order_id IS NULL THEN t.amount ELSE 0.0::DOUBLE END")
    ),
)
def merge_upsert(t: Tables) -> DataFrame:
    return mutate.merge(t.sales, t.late_sales, ["order_id"], update={"amount": F.lit(0.0)})


HASHED = """SELECT *, md5(CAST(order_id AS VARCHAR) || CAST(salesrep_id AS VARCHAR)
        || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR)) AS md5 FROM {table}"""


def _amount_hash() -> Column:
    return hashing.plain_hash(F.col("order_id"), F.col("salesrep_id"), hashing.money(F.col("amount")))


@query(
    "merge_if_changed",
    with_tables(
        "sales late_sales",
        """SELECT t.order_id, CASE WHEN s.md5 <> t.md5 THEN s.order_date ELSE t.order_date END AS order_date,
        CASE WHEN s.md5 <> t.md5 THEN s.salesrep_id ELSE t.salesrep_id END AS salesrep_id,
        CASE WHEN s.md5 <> t.md5 THEN s.amount ELSE t.amount END AS amount,
        CASE WHEN s.md5 <> t.md5 THEN s.md5 ELSE t.md5 END AS md5
        FROM old t LEFT JOIN new s ON s.order_id = t.order_id
        UNION ALL SELECT s.* FROM new s WHERE s.order_id NOT IN (SELECT order_id FROM old)""",
        old=HASHED.format(table="sales"),
        new=HASHED.format(table="late_sales"),
    ),
)
def merge_if_changed(t: Tables) -> DataFrame:
    old, new = (df.withColumn("md5", _amount_hash()) for df in (t.sales, t.late_sales))
    return mutate.merge(old, new, ["order_id"], update="all", when=incoming("md5") != F.col("md5"))


@query(
    "merge_partial_insert",
    with_tables("dim_salesrep", "SELECT * FROM dim_salesrep"),
)
def merge_partial_insert(t: Tables) -> DataFrame:
    """Upsert rows merged on key and state: two columns are set, all are inserted."""
    dimension = t.dim_salesrep_initial
    upserts = scd2.upsert_rows(dimension, t.late_salesreps, REP_SPEC, REP_RUN)
    return scd2.apply_merge(dimension, upserts, REP_SPEC)


# The same changes on a stored table with a folder for each year; the folders that do not change stay as they are.

YEARLY = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INT) AS o_year FROM orders"


def _yearly(t: Tables) -> PartitionedTable:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("o_year"))
    table = PartitionedTable(t.spark, scratch_dir(t.spark, "orders-by-year"), ["o_year"], rows.schema)
    table.write(rows)
    return table


@query(
    "update_where_partitions",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_year = 1996 AND o_custkey < 40 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderpriority, CAST(CASE WHEN o_year = 1996 AND o_custkey < 40 THEN 1997 ELSE o_year END AS INT) AS o_year FROM ({YEARLY})""",
)
def update_where_partitions(t: Tables) -> DataFrame:
    """Some orders of one year get another price and move to the next year."""
    table = _yearly(t)
    condition = (F.col("o_year") == 1996) & (F.col("o_custkey") < 40)
    table.update_where(condition, {"o_totalprice": F.col("o_totalprice") + 1, "o_year": F.lit(1997)})
    return table.read()


@query(
    "delete_where_partitions",
    f"""SELECT * FROM ({YEARLY}) WHERE (o_year = 1995 OR (o_year = 1998 AND o_orderpriority = '5-LOW')) IS NOT TRUE""",
)
def delete_where_partitions(t: Tables) -> DataFrame:
    """A whole year goes, and some orders of another one."""
    table = _yearly(t)
    table.delete_where((F.col("o_year") == 1995) | ((F.col("o_year") == 1998) & (F.col("o_orderpriority") == "5-LOW")))
    return table.read()


@query(
    "merge_partitions",
    f"""WITH old AS ({YEARLY}), new AS (
            SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderpriority, o_year FROM old WHERE o_year = 1997 AND o_custkey < 60
            UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 0.0::DOUBLE, 'new', CAST(2001 AS INT) FROM old WHERE o_year = 1996 AND o_custkey < 60)
        SELECT o.o_orderkey, o.o_custkey, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderpriority, o.o_year
        FROM old o LEFT JOIN new n USING (o_orderkey)
        UNION ALL SELECT * FROM new WHERE o_year = 2001""",
)
def merge_partitions(t: Tables) -> DataFrame:
    """Orders of one year are changed, and a year that was not there is added."""
    table = _yearly(t)
    few = F.col("o_custkey") < 60
    changed = table.read().where((F.col("o_year") == 1997) & few).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    added = table.read().where((F.col("o_year") == 1996) & few).select(
        (F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), "o_custkey", F.lit(0.0).alias("o_totalprice"), F.lit("new").alias("o_orderpriority"), F.lit(2001).alias("o_year")
    )
    table.merge(changed.unionByName(added), ["o_orderkey"], update={"o_totalprice": incoming("o_totalprice")})
    return table.read()


# Four commits: load all orders, correct the finished ones, delete the low-priority ones, bring the
# low-priority open ones back.
LOG_SQL = """log AS (
        SELECT o_orderkey, o_custkey, o_totalprice, 0 AS version, TIMESTAMP '2024-01-01 00:00:00' AS commit_ts, 'I' AS op FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 1, TIMESTAMP '2024-01-02 00:00:00', 'U' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 2, TIMESTAMP '2024-01-03 00:00:00', 'D' FROM orders WHERE o_orderpriority = '5-LOW'
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 2, 3, TIMESTAMP '2024-01-04 00:00:00', 'I' FROM orders
            WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O')"""
STATE_SQL = f"""WITH {LOG_SQL} SELECT o_orderkey, o_custkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM log WHERE {{until}})
        WHERE rn = 1 AND op <> 'D'"""


def order_log(t: Tables) -> DataFrame:
    rows = t.orders
    low = F.col("o_orderpriority") == "5-LOW"

    def priced(raise_by: float) -> list:
        return ["o_orderkey", "o_custkey", (F.col("o_totalprice") + raise_by).alias("o_totalprice")]

    commits = [
        versioned.changes(rows.select(*priced(0)), 0, "2024-01-01 00:00:00", "I"),
        versioned.changes(rows.where(F.col("o_orderstatus") == "F").select(*priced(1)), 1, "2024-01-02 00:00:00", "U"),
        versioned.changes(rows.where(low).select(*priced(0)), 2, "2024-01-03 00:00:00", "D"),
        versioned.changes(
            rows.where(low & (F.col("o_orderstatus") == "O")).select(*priced(2)), 3, "2024-01-04 00:00:00", "I"
        ),
    ]
    log = commits[0]
    for commit in commits[1:]:
        log = log.unionByName(commit)
    return log


@query(
    "table_history",
    f"""WITH {LOG_SQL} SELECT version, commit_ts, count(*) FILTER (WHERE op = 'I') AS inserted,
        count(*) FILTER (WHERE op = 'U') AS updated, count(*) FILTER (WHERE op = 'D') AS deleted
        FROM log GROUP BY version, commit_ts""",
)
def table_history(t: Tables) -> DataFrame:
    return versioned.history(order_log(t))


@query("as_of_version", STATE_SQL.format(until="version <= 2"))
def as_of_version(t: Tables) -> DataFrame:
    return versioned.state_at(order_log(t), ["o_orderkey"], version=2)


@query("scan_versioned", STATE_SQL.format(until="commit_ts <= TIMESTAMP '2024-01-02 12:00:00'"))
def scan_versioned(t: Tables) -> DataFrame:
    return versioned.state_at(order_log(t), ["o_orderkey"], timestamp="2024-01-02 12:00:00")


def _stored_log(t: Tables) -> str:
    """The four commits appended one by one, with a snapshot after every second one."""
    path, log = scratch_dir(t.spark, "order-log"), order_log(t)
    for version in range(4):
        versioned.append_commit(log.where(F.col("_version") == version), path, ["o_orderkey"], version, every=2)
    return path


@query("as_of_version_snapshot", STATE_SQL.format(until="version <= 2"))
def as_of_version_snapshot(t: Tables) -> DataFrame:
    """The same state from the snapshot at version 1 and the changes of version 2."""
    return versioned.read_at(t.spark, _stored_log(t), ["o_orderkey"], version=2)


@query("scan_versioned_snapshot", STATE_SQL.format(until="commit_ts <= TIMESTAMP '2024-01-03 12:00:00'"))
def scan_versioned_snapshot(t: Tables) -> DataFrame:
    return versioned.read_at(t.spark, _stored_log(t), ["o_orderkey"], timestamp="2024-01-03 12:00:00")


@query(
    "update_from_join",
    with_tables(
        "order_rides",
        """SELECT ride_id, start_time, CASE WHEN km IS NULL THEN NULL ELSE start_time
            + to_seconds(CAST(floor(km * 1000 / (4.0::DOUBLE + (ride_id % 300) / 100.0::DOUBLE)) AS INT)) END AS end_time
        FROM (SELECT *, round(sqrt(pow(start_lat - end_lat, 2) + pow(start_lon - end_lon, 2)) * 111.32::DOUBLE, 3) AS km
              FROM order_rides)""",
    ),
)
def update_from_join(t: Tables) -> DataFrame:
    """New ride ends from distance and speed; a ride without a distance loses its end."""
    points = [F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")]
    km = F.round(geo.degree_distance_km(*points), 3)
    seconds = F.floor(km * 1000 / geo.assumed_speed(F.col("ride_id")))
    later = F.col("start_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    ends = t.order_rides.select("ride_id", later.alias("new_end"))
    rides = t.order_rides.select("ride_id", "start_time", "end_time")
    return mutate.update_from(rides, ends, ["ride_id"], {"end_time": incoming("new_end")})


@query(
    "shift_dates",
    "SELECT o_orderkey, o_orderdate + INTERVAL 4 YEARS AS o_orderdate FROM orders",
)
def shift_dates(t: Tables) -> DataFrame:
    return mutate.shift_dates(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate"], 4)


@query(
    "expire_rows",
    with_tables(
        "salesreps late_salesreps dim_salesrep_initial",
        f"""SELECT d.* EXCLUDE (scd_end, is_current),
        CASE WHEN s.salesrep_id IS NOT NULL THEN TIMESTAMP '{REP_RUN}' ELSE scd_end END AS scd_end,
        s.salesrep_id IS NULL AS is_current
        FROM dim_salesrep_initial d LEFT JOIN late_salesreps s ON s.salesrep_id = d.salesrep_id AND s.office <> d.office""",
    ),
)
def expire_rows(t: Tables) -> DataFrame:
    changes = scd2.detect_changes(t.dim_salesrep_initial, t.late_salesreps, REP_SPEC)
    changed = changes.where(F.col("change") == "changed")
    return mutate.expire(t.dim_salesrep_initial, changed, "salesrep_id", "scd_end", "is_current", REP_RUN)


# --- slowly changing dimensions ------------------------------------------------------------------


@query("scd2_initial", with_tables("dim_user", "SELECT * FROM dim_user"))
def scd2_initial(t: Tables) -> DataFrame:
    return scd2.initial_load(t.users, USER_SPEC, "1996-01-01 00:00:00")


@query(
    "scd2_detect_changes",
    with_tables(
        "dim_salesrep_initial late_salesreps",
        """SELECT s.salesrep_id, s.name, s.office, md5(s.name || s.office) AS md5,
        CASE WHEN d.salesrep_id IS NULL THEN 'new' WHEN d.name <> s.name OR d.office <> s.office THEN 'changed'
             ELSE 'unchanged' END AS change
        FROM late_salesreps s LEFT JOIN dim_salesrep_initial d ON d.salesrep_id = s.salesrep_id AND d.is_current""",
    ),
)
def scd2_detect_changes(t: Tables) -> DataFrame:
    return scd2.detect_changes(t.dim_salesrep_initial, t.late_salesreps, REP_SPEC)


@query("scd2_apply_expire_insert", with_tables("dim_salesrep", "SELECT * FROM dim_salesrep"))
def scd2_apply_expire_insert(t: Tables) -> DataFrame:
    return scd2.apply_snapshot(t.dim_salesrep_initial, t.late_salesreps, REP_SPEC, REP_RUN)


@query(
    "scd2_apply_merge",
    with_tables(
        "dim_user",
        """SELECT user_sk, d.user_id, d.street, d.number, d.zipcode, d.city, d.country_code, start_date,
            CASE WHEN d.number IS NULL THEN TIMESTAMP '1997-03-01 00:00:00' ELSE end_date END AS end_date,
            d.number IS NOT NULL AS is_current, md5 FROM dim_user d
        UNION ALL SELECT md5(CAST(user_id AS VARCHAR) || '|1997-03-01 00:00:00'), user_id, street, '1', zipcode, city, country_code,
            TIMESTAMP '1997-03-01 00:00:00', TIMESTAMP '2100-12-31 00:00:00', TRUE,
            md5(concat_ws('|', street, '1', zipcode, city, country_code)) FROM users WHERE number IS NULL""",
    ),
)
def scd2_apply_merge(t: Tables) -> DataFrame:
    """Users whose house number became known; the hash sees the former NULL."""
    source = t.users.withColumn("number", F.coalesce("number", F.lit("1")))
    upserts = scd2.upsert_rows(t.dim_user, source, USER_SPEC, "1997-03-01 00:00:00")
    return scd2.apply_merge(t.dim_user, upserts, USER_SPEC)


def operated_orders(t: Tables) -> DataFrame:
    """The log of a table that was loaded, updated, deleted from and merged into."""
    columns = ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    loaded = t.orders.select(*columns)
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    raised = mutate.update_where(loaded, status == "F", {"o_totalprice": F.col("o_totalprice") + 1})
    reduced = mutate.delete_where(raised, low)
    back = loaded.where((low & (status == "O")) | (status == "P")).withColumn("o_totalprice", F.col("o_totalprice") + 2)
    merged = mutate.merge(reduced, back, ["o_orderkey"], update="all")
    moments = [f"2024-02-0{day} 00:00:00" for day in (1, 2, 3, 4)]
    return versioned.log_of(list(zip((loaded, raised, reduced, merged), moments)), ["o_orderkey"])


@query(
    "history_of_operations",
    """SELECT * FROM (
        SELECT 0 AS version, TIMESTAMP '2024-02-01 00:00:00' AS commit_ts, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS deleted FROM orders
        UNION ALL SELECT 1, TIMESTAMP '2024-02-02 00:00:00', 0, count(*), 0 FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 2, TIMESTAMP '2024-02-03 00:00:00', 0, 0, count(*) FROM orders WHERE o_orderpriority = '5-LOW'
        UNION ALL SELECT 3, TIMESTAMP '2024-02-04 00:00:00',
            count(*) FILTER (WHERE o_orderpriority = '5-LOW' AND o_orderstatus IN ('O', 'P')),
            count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'P'), 0 FROM orders)
        WHERE inserted + updated + deleted > 0""",
)
def history_of_operations(t: Tables) -> DataFrame:
    return versioned.history(operated_orders(t))


@query(
    "state_after_operations",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority,
        o_totalprice + CASE WHEN o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW') THEN 2
                            WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice
        FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus IN ('O', 'P')""",
)
def state_after_operations(t: Tables) -> DataFrame:
    return versioned.state_at(operated_orders(t), ["o_orderkey"])
