"""Property graph of rides, stations, districts, users and vehicles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.functions import dates
from wheelhouse.functions.text import prefixed, street_line
from wheelhouse.operators.joins import sized

PROPERTIES = "properties"


def ride_base(
    rides: DataFrame,
    vehicles: DataFrame,
    subscriptions: DataFrame,
    users: DataFrame,
    locks: DataFrame,
    stations: DataFrame,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Rides with vehicle, user and both stations; the end station is optional.

    ``since`` and ``until`` keep the rides that start on these days or between them.
    """
    if since is not None:
        rides = rides.where(F.col("start_time") >= F.lit(since).cast("date").cast("timestamp_ntz"))
    if until is not None:
        rides = rides.where(F.col("start_time") < F.date_add(F.lit(until).cast("date"), 1).cast("timestamp_ntz"))
    placed, people = sized(locks.join(stations, "station_id"), users.select("user_id", "email", "city"))

    def side(name: str) -> DataFrame:
        columns = ("station_id", "street", "district", "number", "zipcode")
        return placed.select(
            F.col("lock_id").alias(f"{name}_lock_id"), *(F.col(c).alias(f"{name}_{c}") for c in columns)
        )

    joined = (
        rides.select("ride_id", "start_time", "end_time", "vehicle_id", "subscription_id", "start_lock_id", "end_lock_id")
        .join(vehicles.select("vehicle_id", "serial_number"), "vehicle_id")
        .join(subscriptions.select("subscription_id", "user_id"), "subscription_id")
        .join(people, "user_id")
        .join(side("start"), "start_lock_id")
        .join(side("end"), "end_lock_id", "left")
    )
    return joined.drop("subscription_id", "start_lock_id", "end_lock_id")


def _typed(properties: dict[str, Column]) -> Column:
    """Properties with their own types in one column for all labels; numbers stay numbers in the files."""
    if not properties:
        return F.parse_json(F.lit("{}"))
    return F.to_variant_object(F.struct(*(value.alias(name) for name, value in properties.items())))


def _node(node_id: Column, label: str, properties: dict[str, Column]) -> Column:
    return F.struct(node_id.alias("id"), F.array(F.lit(label)).alias("labels"), _typed(properties).alias(PROPERTIES))


def _edge(edge_id: Column, kind: str, start: Column, end: Column) -> Column:
    return F.struct(
        edge_id.alias("id"),
        F.lit(kind).alias("type"),
        start.alias("startNode"),
        end.alias("endNode"),
        _typed({}).alias(PROPERTIES),
    )


def district_nodes(stations: DataFrame) -> DataFrame:
    districts = stations.select("district").distinct()
    node = _node(prefixed("d", F.col("district")), "District", {"name": F.col("district")})
    return districts.select(F.inline(F.array(node)))


def station_nodes(stations: DataFrame) -> DataFrame:
    node = _node(
        prefixed("s", F.col("station_id")),
        "Station",
        {
            "stationId": F.col("station_id"),
            "name": street_line(F.col("street"), F.col("number")),
            "zipcode": F.col("zipcode"),
        },
    )
    return stations.select("station_id", "street", "district", "number", "zipcode").distinct().select(F.inline(F.array(node)))


def rider_nodes(base: DataFrame) -> DataFrame:
    """Users and vehicles of the rides, each once.

    Both kinds come out of one pass over the rides; the grouping combines on the map side, so a user
    with very many rides costs one row per task.
    """
    user = F.struct(
        F.lit("User").alias("kind"), F.col("user_id").alias("key"), F.col("email").alias("a"), F.col("city").alias("b")
    )
    vehicle = F.struct(
        F.lit("Vehicle").alias("kind"),
        F.col("vehicle_id").alias("key"),
        F.col("serial_number").alias("a"),
        F.lit(None).cast("string").alias("b"),
    )
    once = base.select(F.inline(F.array(user, vehicle))).distinct()
    as_user = _node(prefixed("u", F.col("key")), "User", {"userId": F.col("key"), "email": F.col("a"), "city": F.col("b")})
    as_vehicle = _node(prefixed("v", F.col("key")), "Vehicle", {"vehicleId": F.col("key"), "serialNumber": F.col("a")})
    return once.select(F.inline(F.array(F.when(F.col("kind") == "User", as_user).otherwise(as_vehicle))))


def ride_nodes(base: DataFrame) -> DataFrame:
    start, end = F.col("start_time"), F.col("end_time")
    node = _node(
        prefixed("r", F.col("ride_id")),
        "Ride",
        {
            "rideId": F.col("ride_id"),
            "startTime": dates.format_timestamp(start),
            "endTime": dates.format_timestamp(end),
            "duration": dates.elapsed_seconds(start, end).cast("double"),
        },
    )
    return base.select(F.inline(F.array(node)))


def nodes(base: DataFrame, stations: DataFrame) -> DataFrame:
    parts = [district_nodes(stations), station_nodes(stations), rider_nodes(base)]
    result = ride_nodes(base)
    for part in parts:
        result = result.unionByName(part)
    return result


def station_edges(stations: DataFrame) -> DataFrame:
    edge = _edge(
        prefixed("sd", F.col("station_id")),
        "LOCATED_IN",
        prefixed("s", F.col("station_id")),
        prefixed("d", F.col("district")),
    )
    return stations.select("station_id", "district").distinct().select(F.inline(F.array(edge)))


def ride_edges(base: DataFrame) -> DataFrame:
    """The three or four relationships of every ride, from one pass and without a shuffle."""
    ride, key = prefixed("r", F.col("ride_id")), F.col("ride_id")
    end_station = F.col("end_station_id")
    edges = F.array_compact(
        F.array(
            _edge(prefixed("rs", key), "STARTS_AT", ride, prefixed("s", F.col("start_station_id"))),
            F.when(
                end_station.isNotNull(), _edge(prefixed("re", key), "ENDS_AT", ride, prefixed("s", end_station))
            ),
            _edge(prefixed("rv", key), "USES", ride, prefixed("v", F.col("vehicle_id"))),
            _edge(prefixed("ru", key), "TAKEN_BY", ride, prefixed("u", F.col("user_id"))),
        )
    )
    return base.select(F.inline(edges))


def edges(base: DataFrame, stations: DataFrame) -> DataFrame:
    return station_edges(stations).unionByName(ride_edges(base))


def summary(node_rows: DataFrame, edge_rows: DataFrame) -> DataFrame:
    """Number of nodes per label and of relationships per type."""
    by_label = node_rows.groupBy(F.col("labels")[0].alias("name")).agg(F.count(F.lit(1)).alias("total"))
    by_type = edge_rows.groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("total"))
    return by_label.select(F.lit("node").alias("element"), "name", "total").unionByName(
        by_type.select(F.lit("relationship").alias("element"), "name", "total")
    )
