"""Readers and writers, the scratch folder and the database options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wheelhouse import session
from wheelhouse.operators.layout import spread
from wheelhouse.session import scratch_dir
from wheelhouse.sinks import files as sink
from wheelhouse.sources import files as source
from wheelhouse.sources.generated import date_sequence, dates_covering, inline_rows
from wheelhouse.sources.jdbc import Database, RangeSplit, derived_table


def test_name_list_without_its_headers(spark, tmp_path, rows):
    (tmp_path / "types.csv").write_text("weather_type\nPleasant\nUnpleasant\nweather_type\nNeutral\n")
    assert rows(source.read_name_list(spark, str(tmp_path / "types.csv"), "weather_type")) == [
        ("Neutral",), ("Pleasant",), ("Unpleasant",),
    ]


def test_csv_with_and_without_schema(spark, tmp_path):
    (tmp_path / "e.csv").write_text("id,hired\n1,2020-01-10\n2,\n")
    path = str(tmp_path / "e.csv")
    given = source.read_csv(spark, path, "id long, hired date")
    assert [tuple(r) for r in given.collect()] == [(1, dt.date(2020, 1, 10)), (2, None)]
    assert dict(source.read_csv(spark, path).dtypes) == {"id": "int", "hired": "date"}


def test_partitioned_write_keeps_undated_rows(spark, tmp_path, rows):
    path = str(tmp_path / "facts")
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, None)], "id int, year int")
    sink.write_partitioned(df, path, ["year"])
    assert rows(spark.read.parquet(path)) == [(1, 2020), (2, 2021), (3, None)]
    assert rows(spark.read.parquet(path).where("year = 2021")) == [(2, 2021)]


def test_dominant_partition_is_written_by_several_tasks(spark, tmp_path):
    """Nearly all rows in one year still give several files of that year."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, 2019).otherwise(2020).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        sink.write_partitioned(df, str(tmp_path / "y"), ["year"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "y" / "year=2020").glob("*.parquet"))) > 2
    assert len(list((tmp_path / "y" / "year=2019").glob("*.parquet"))) == 1


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_rides", "bucketed_subscriptions"):
            df = spark.range(100).withColumnRenamed("id", "subscription_id")
            sink.save_table(df, name, path=str(tmp_path / name), buckets=4, bucket_by=["subscription_id"])
        joined = spark.table("bucketed_rides").join(spark.table("bucketed_subscriptions"), "subscription_id")
        assert joined.count() == 100
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_rides", "bucketed_subscriptions"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_spread_moves_only_few_pieces(spark):
    cores = spark.sparkContext.defaultParallelism
    few = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert spread(few).rdd.getNumPartitions() == cores
    path = scratch_dir(spark, "many")
    spark.range(0, 100, 1, cores).write.parquet(path)
    many = spark.read.parquet(path)
    assert spread(many) is many


def test_row_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.write_counted(spark.range(3), path) == 3
    assert tuple(sink.row_counts(spark, 3, path).first()) == (3, 3, True)
    assert tuple(sink.row_counts(spark, 4, path).first()) == (4, 3, False)


def test_path_probe(spark, tmp_path):
    assert not source.path_exists(spark, str(tmp_path / "nothing"))


def test_dates(spark):
    days = date_sequence(spark, "2024-02-28", "2024-03-01")
    assert [str(r.date) for r in days.orderBy("date").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    df = spark.sql("SELECT timestamp_ntz'2023-05-05 10:00:00' AS t UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:00'")
    span = dates_covering(df, "t").agg(F.min("date"), F.max("date"), F.count("date")).first()
    assert tuple(map(str, span)) == ("2023-01-01", "2024-12-31", "731")


def test_a_wild_date_makes_no_calendar(spark):
    with pytest.raises(Exception, match="too many days"):
        date_sequence(spark, "2020-01-01", "9999-12-31").count()


def test_inline_rows(spark):
    df = inline_rows(spark, [(1, None), (2, "b")], "id int, name string")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, None), (2, "b")]
    assert df.dtypes == [("id", "int"), ("name", "string")]


def test_scratch_follows_the_cluster_setting(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir", "")
    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    assert first != second
    if shared:
        assert first.startswith(f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/x-")


def test_scratch_of_a_run_is_removed_by_its_owner(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_root", lambda _: f"file://{tmp_path}")
    path = session.scratch_dir(spark, "x")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark)
    assert not list(tmp_path.iterdir())


class _Session:
    """Just enough of a session to ask for the scratch folder."""

    def __init__(self, master: str, folder: str) -> None:
        self.conf, self.sparkContext, self.master, self.applicationId = self, self, master, master
        self.folder = folder

    def get(self, name: str, default: str | None = None) -> str | None:
        return {"spark.checkpoint.dir": self.folder, "spark.sql.warehouse.dir": "hdfs:///warehouse/"}.get(name, default)


def test_scratch_is_never_a_folder_of_one_machine():
    assert session.scratch_root(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.scratch_root(_Session("yarn", "")) == "hdfs:///warehouse/_scratch"


# No database is started for tests; these check what is handed to Spark's JDBC source.

BASE = Database("jdbc:postgresql://db/rides", "org.postgresql.Driver", {"user": "reader"}, fetch_size=500)


def test_database_options():
    assert BASE.options() == {
        "url": "jdbc:postgresql://db/rides",
        "driver": "org.postgresql.Driver",
        "user": "reader",
        "fetchsize": "500",
    }
    assert "reader" not in repr(BASE)
    assert RangeSplit("ride_id", 0, 1000, 4).options() == {
        "partitionColumn": "ride_id",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "4",
    }
    assert derived_table(" SELECT a FROM t; ") == "(SELECT a FROM t) subq"


class _Recorder:
    """Stands in for a reader or writer and keeps what it is told."""

    def __init__(self) -> None:
        self.told: dict[str, str] = {}

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **more):
        self.told.update(more)
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = "yes"


def test_database_reads_and_writes():
    split = RangeSplit("id", 0, 10, 2)
    assert BASE.table(_Recorder(), "rides", split)["dbtable"] == "rides"
    assert BASE.table(_Recorder(), "rides", split)["numPartitions"] == "2"
    assert BASE.query(_Recorder(), "SELECT 1")["query"] == "SELECT 1"
    assert BASE.subquery(_Recorder(), "SELECT id FROM t", split)["dbtable"] == "(SELECT id FROM t) subq"
    assert BASE.has_table(_Recorder(), "rides")
    appended, replaced = _Recorder(), _Recorder()
    BASE.write(appended, "fact")
    BASE.write(replaced, "dim", mode="overwrite")
    assert appended.told["mode"] == "append" and "truncate" not in appended.told
    assert replaced.told["mode"] == "overwrite" and replaced.told["truncate"] == "true"


class _Failing:
    """A session whose reader fails as a database would."""

    def __init__(self, state: str) -> None:
        self.error = RuntimeError("database")
        self.error.sql_state = state

    @property
    def read(self):
        raise self.error


def test_only_a_missing_table_is_not_there(spark):
    assert not BASE.has_table(_Failing("42P01"), "t")
    with pytest.raises(RuntimeError, match="database"):
        BASE.has_table(_Failing("28P01"), "t")
    with pytest.raises(Exception):  # noqa: B017  no driver for it: the class of the error is Spark's own
        Database("jdbc:nothing:at:all").has_table(spark, "t")


def test_only_a_missing_path_is_not_there(spark, tmp_path):
    assert not source.path_exists(spark, str(tmp_path / "none"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        source.path_exists(spark, str(tmp_path / "broken"))
