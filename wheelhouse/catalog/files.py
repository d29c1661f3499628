"""Sources and sinks: what is written to the shared scratch folder is read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.catalog.bindings import Tables, with_tables
from wheelhouse.catalog.changes import LOG_SQL, STATE_SQL, order_log
from wheelhouse.catalog.marts import (
    BASE,
    EDGES,
    FACT_TABLES,
    FACTS,
    GRAPH_TABLES,
    MEASURES,
    NODES,
    fact_rides,
    graph_base,
)
from wheelhouse.catalog.registry import query
from wheelhouse.functions import text
from wheelhouse.operators import quality
from wheelhouse.plans import facts, graph, words
from wheelhouse.session import scratch_dir
from wheelhouse.sinks import files as sink
from wheelhouse.sinks.audited import AuditedTable, known_keys
from wheelhouse.sinks.graph import write_graph
from wheelhouse.sources import files as source
from wheelhouse.sources import versioned

LINES_SQL = """SELECT unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)))
        AS value FROM documents"""

# --- sources -------------------------------------------------------------------------------------


@query("scan_parquet", "SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'")
def scan_parquet(t: Tables) -> DataFrame:
    lines = source.read_parquet(t.spark, t.path("lineitem"))
    recent = F.col("l_shipdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return lines.where(recent).select("l_orderkey", "l_partkey", "l_shipdate")


@query(
    "scan_csv",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_csv(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "customer-csv")
    t.customer.write.option("header", True).csv(path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return source.read_csv(t.spark, path, schema)


@query(
    "scan_text_lines",
    f"SELECT value, count(*) AS times FROM ({LINES_SQL}) GROUP BY value",
)
def scan_text_lines(t: Tables) -> DataFrame:
    """Whole documents written as text and read line by line."""
    path = scratch_dir(t.spark, "lines")
    t.documents.select("text").write.text(path)
    return source.read_lines(t.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("times"))


@query(
    "scan_json_nested",
    with_tables(
        "weather",
        "SELECT zipcode, epoch AS dt, condition, kelvin, CAST(1013 AS INT) AS pressure, CAST(NULL AS INT) AS humidity FROM weather",
    ),
)
def scan_json_nested(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "weather-json")
    t.weather_documents.select("value").write.text(path)
    doc = source.parse_json(F.col("value"), source.WEATHER_SCHEMA)
    return source.read_lines(t.spark, path).select(doc.alias("d")).select(
        F.col("d.zipCode").alias("zipcode"),
        "d.dt",
        F.get("d.weather", F.lit(0))["main"].alias("condition"),
        F.col("d.main.temp").alias("kelvin"),
        "d.main.pressure",
        "d.main.humidity",
    )


@query(
    "scan_json_paths",
    with_tables("weather", "SELECT zipcode, epoch AS dt, condition, kelvin, CAST(NULL AS VARCHAR) AS country FROM weather"),
)
def scan_json_paths(t: Tables) -> DataFrame:
    return source.json_paths(
        t.weather_documents,
        "value",
        {
            "zipcode": ("$.zipCode", "string"),
            "dt": ("$.dt", "long"),
            "condition": ("$.weather[0].main", "string"),
            "kelvin": ("$.main.temp", "double"),
            "country": ("$.sys.country", "string"),
        },
    )


@query(
    "scan_weather_types_csv",
    with_tables("weather", "SELECT condition AS weather_type, count(*) AS lines FROM weather GROUP BY condition"),
)
def scan_weather_types_csv(t: Tables) -> DataFrame:
    """A list whose header line comes twice in every file; neither copy is a member."""
    path = scratch_dir(t.spark, "weather-types")
    header = t.spark.range(1).select(F.lit("weather_type").alias("weather_type"))
    listed = t.weather.select(F.col("condition").alias("weather_type"))
    header.unionByName(listed).write.option("header", True).csv(path)
    members = source.read_name_list(t.spark, path, "weather_type")
    return members.groupBy("weather_type").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "scan_saved_tables",
    """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
        JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
)
def scan_saved_tables(t: Tables) -> DataFrame:
    folder = scratch_dir(t.spark, "saved")
    saved = {f"saved_{name}": f"{folder}/{name}" for name in ("customer", "nation")}
    for name in ("customer", "nation"):
        sink.write_parquet(t.read(name), saved[f"saved_{name}"])
    source.open_views(t.spark, saved)
    return t.spark.sql(
        """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM saved_customer
        JOIN saved_nation ON n_nationkey = c_nationkey GROUP BY n_name"""
    )


# --- sinks ---------------------------------------------------------------------------------------


@query("write_parquet_table", with_tables("dim_lock", "SELECT * FROM dim_lock"))
def write_parquet_table(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "dim-lock")
    sink.write_parquet(t.dim_lock, path)
    return source.read_parquet(t.spark, path)


@query(
    "write_parquet_partitioned",
    with_tables(
        FACT_TABLES,
        """SELECT year, count(*) AS rides, CAST(sum(ride_id) AS BIGINT) AS id_sum FROM facts
        LEFT JOIN dim_date USING (date_sk) GROUP BY year""",
        measures=MEASURES,
        facts=FACTS,
    ),
)
def write_parquet_partitioned(t: Tables) -> DataFrame:
    """The whole fact in year folders from one job; counts come from the files."""
    path = scratch_dir(t.spark, "fact-ride")
    sink.write_partitioned(facts.with_year(fact_rides(t), t.dim_date), path, ["year"])
    return source.read_parquet(t.spark, path).groupBy("year").agg(
        F.count(F.lit(1)).alias("rides"), F.sum("ride_id").alias("id_sum")
    )


@query("offset_batches", with_tables(FACT_TABLES, FACTS, measures=MEASURES))
def offset_batches(t: Tables) -> DataFrame:
    """What a paged export would put out page by page, written at once and read back whole."""
    path = scratch_dir(t.spark, "fact-pages")
    sink.write_partitioned(facts.with_year(fact_rides(t), t.dim_date), path, ["year"], max_records_per_file=500_000)
    return source.read_parquet(t.spark, path).drop("year", "month")


@query("write_versioned_table", STATE_SQL.format(until="TRUE"))
def write_versioned_table(t: Tables) -> DataFrame:
    """Four commits appended to a log on shared storage, and the state they lead to."""
    path = scratch_dir(t.spark, "order-log")
    versioned.append_changes(order_log(t), path)
    return versioned.state_at(versioned.read_log(t.spark, path), ["o_orderkey"])


@query("save_managed_table", f"WITH {LOG_SQL} SELECT version, op, count(*) AS changes FROM log GROUP BY version, op")
def save_managed_table(t: Tables) -> DataFrame:
    folder = scratch_dir(t.spark, "table")
    name = "order_log_" + folder.rsplit("-", 1)[-1]
    sink.save_table(order_log(t), name, path=folder)
    return t.spark.table(name).groupBy(F.col("_version").alias("version"), F.col("_op").alias("op")).agg(
        F.count(F.lit(1)).alias("changes")
    )


@query(
    "write_text_counts",
    f"""SELECT substr(word, 1, 1) || ',' || CAST(count(*) AS VARCHAR) AS value
        FROM (SELECT unnest(string_split(value, ' ')) AS word FROM ({LINES_SQL})) WHERE word <> '' GROUP BY substr(word, 1, 1)""",
)
def write_text_counts(t: Tables) -> DataFrame:
    """Counts of first letters over all lines, as text lines."""
    path = scratch_dir(t.spark, "letters")
    counted = words.word_counts(words.lines_of(t.documents, "text"), "value")
    sink.write_pairs_as_text(words.letter_counts(counted), path, ["letter", "amount"])
    return source.read_lines(t.spark, path)


@query(
    "write_graph_json",
    with_tables(GRAPH_TABLES, "SELECT type, startNode, endNode, id FROM edges", base=BASE, edges=EDGES),
)
def write_graph_json(t: Tables) -> DataFrame:
    base = sink.staged(graph_base(t), "ride-base")
    written = write_graph(graph.nodes(base, t.stations), graph.edges(base, t.stations), scratch_dir(t.spark, "graph"))
    schema = "id string, type string, startNode string, endNode string"
    return t.spark.read.schema(schema).json(written["relationships"]).select("type", "startNode", "endNode", "id")


@query(
    "write_graph_nodes",
    with_tables(
        GRAPH_TABLES,
        """SELECT id, label, coalesce(json_extract_string(properties, '$.name'), json_extract_string(properties, '$.city')) AS name,
            CAST(coalesce(json_extract(properties, '$.stationId'), json_extract(properties, '$.userId'),
                json_extract(properties, '$.vehicleId'), json_extract(properties, '$.rideId')) AS BIGINT) AS number,
            CAST(json_extract(properties, '$.duration') AS DOUBLE) AS duration FROM nodes""",
        base=BASE,
        nodes=NODES,
    ),
)
def write_graph_nodes(t: Tables) -> DataFrame:
    """Node files read back: numbers are numbers there, whatever the label."""
    base = sink.staged(graph_base(t), "ride-base")
    written = write_graph(graph.nodes(base, t.stations), graph.edges(base, t.stations), scratch_dir(t.spark, "graph"))
    found = t.spark.read.schema("id string, labels array<string>, properties variant").json(written["nodes"])
    number = [F.try_variant_get(F.col("properties"), f"$.{name}", "bigint") for name in ("stationId", "userId", "vehicleId", "rideId")]
    name = [F.try_variant_get(F.col("properties"), f"$.{name}", "string") for name in ("name", "city")]
    duration = F.try_variant_get(F.col("properties"), "$.duration", "double")
    return found.select("id", F.col("labels")[0].alias("label"), F.coalesce(*name).alias("name"), F.coalesce(*number).alias("number"), duration.alias("duration"))


@query(
    "graph_dangling_edges",
    with_tables(
        GRAPH_TABLES,
        """SELECT endNode AS key, count(*) AS row_count FROM edges WHERE endNode LIKE '%7' OR endNode NOT IN (SELECT 'r-' || ride_id FROM base
            UNION ALL SELECT 's-' || station_id FROM stations UNION ALL SELECT 'd-' || district FROM stations
            UNION ALL SELECT 'u-' || user_id FROM base UNION ALL SELECT 'v-' || vehicle_id FROM base) GROUP BY endNode""",
        base=BASE,
        edges=EDGES,
    ),
)
def graph_dangling_edges(t: Tables) -> DataFrame:
    """Edges to nodes that are not there: those whose name ends in 7 were not exported."""
    base = sink.staged(graph_base(t), "ride-base")
    exported = graph.nodes(base, t.stations).where(~F.col("id").endswith("7"))
    return quality.orphans(graph.edges(base, t.stations), "endNode", exported, "id")


@query(
    "render_insert_rows",
    with_tables(
        "order_rides users",
        r"""SELECT 'INSERT INTO rides (startpoint, starttime, endtime, vehicleid, subscriptionid, startlockid, street) VALUES ('
        || coalesce('POINT(' || CAST(CAST(start_lat AS DECIMAL(9,4)) AS VARCHAR) || ',' || CAST(CAST(start_lon AS DECIMAL(9,4)) AS VARCHAR) || ')', 'NULL')
        || ', TO_TIMESTAMP(''' || strftime(start_time, '%Y-%m-%d %H:%M:%S') || ''',''YYYY-MM-DD HH24:MI:SS'')'
        || ', TO_TIMESTAMP(''' || strftime(end_time, '%Y-%m-%d %H:%M:%S') || ''',''YYYY-MM-DD HH24:MI:SS'')'
        || ', ' || vehicle_id || ', ' || coalesce(CAST(subscription_id AS VARCHAR), 'NULL') || ', '
        || coalesce(CAST(start_lock_id AS VARCHAR), 'NULL') || ', ''' || replace('O''' || ride_id, '''', '''''') || ''');' AS value
        FROM order_rides""",
    ),
)
def render_insert_rows(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "inserts")
    lat, lon = (F.col(c).cast("decimal(9,4)") for c in ("start_lat", "start_lon"))
    literals = {
        "startpoint": text.sql_point(lat, lon),
        "starttime": text.sql_timestamp(F.col("start_time")),
        "endtime": text.sql_timestamp(F.col("end_time")),
        "vehicleid": text.sql_number(F.col("vehicle_id")),
        "subscriptionid": text.sql_number(F.col("subscription_id")),
        "startlockid": text.sql_number(F.col("start_lock_id")),
        "street": text.sql_text(F.concat(F.lit("O'"), F.col("ride_id").cast("string"))),
    }
    statement = sink.insert_statements("rides", list(literals), list(literals.values()))
    t.order_rides.select(statement.alias("value")).write.text(path)
    return source.read_lines(t.spark, path)


@query(
    "write_row_count_check",
    "SELECT count(*) AS expected, count(*) AS found, TRUE AS matches FROM customer",
)
def write_row_count_check(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "checked")
    written = sink.write_counted(t.customer, path)
    return sink.row_counts(t.spark, written, path)


@query(
    "probe_saved_table",
    """SELECT 'days' AS name, FALSE AS before_write, TRUE AS after_write, count(DISTINCT o_orderdate) AS days FROM orders""",
)
def probe_saved_table(t: Tables) -> DataFrame:
    """Whether a table is there decides between a first and a later load."""
    path = scratch_dir(t.spark, "probe")
    before = source.path_exists(t.spark, path)
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    sink.write_parquet(days, path)
    return source.read_parquet(t.spark, path).agg(
        F.lit("days").alias("name"),
        F.lit(before).alias("before_write"),
        F.lit(source.path_exists(t.spark, path)).alias("after_write"),
        F.count("day").alias("days"),
    )


@query(
    "write_audited",
    with_tables(
        "order_rides locks",
        """SELECT ride_id, concat_ws(', ', CASE WHEN end_time < start_time THEN 'ends before it starts' END,
            CASE WHEN end_time IS NULL THEN 'no end' END,
            CASE WHEN end_lock_id NOT IN (SELECT lock_id FROM locks WHERE lock_id % 2 = 0) THEN 'unknown lock' END) AS reasons
        FROM order_rides""",
    ),
)
def write_audited(t: Tables) -> DataFrame:
    """Rides that keep all constraints are published, the others are in quarantine with their reasons."""
    rides = t.order_rides.select("ride_id", "start_time", "end_time", "end_lock_id")
    bad = {
        "ends before it starts": F.col("end_time") < F.col("start_time"),
        "no end": F.col("end_time").isNull(),
        "unknown lock": ~F.col("lock_is_known"),
    }
    path = scratch_dir(t.spark, "audited-rides")
    table = AuditedTable(t.spark, path, rides.schema, bad, allowed=10_000_000_000)
    table.load("all rides", known_keys(rides, "end_lock_id", t.locks.where("lock_id % 2 = 0"), "lock_id", "lock_is_known"))
    published = table.read().select("ride_id", F.lit("").alias("reasons"))
    return published.unionByName(table.quarantine("all rides").select("ride_id", F.array_join("reasons", ", ").alias("reasons")))
