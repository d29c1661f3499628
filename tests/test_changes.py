"""MERGE, UPDATE, DELETE, history and type-2 dimensions on small frames."""

import datetime as dt
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wheelhouse.operators import keys, mutate, scd2
from wheelhouse.operators.mutate import incoming
from wheelhouse.sources import versioned

# The practice transactions.
TRANSACTIONS = [
    (1, 101, "2023-06-01", "Product A", 2),
    (2, 102, "2023-06-02", "Product B", 5),
    (3, 103, "2023-06-03", "Product A", 3),
    (4, 101, "2023-06-04", "Product C", 1),
    (5, 104, "2023-06-05", "Product B", 4),
    (6, 102, "2023-06-06", "Product A", 2),
    (7, 103, "2023-06-07", "Product C", 3),
    (8, 101, "2023-06-08", "Product B", 5),
    (9, 104, "2023-06-09", "Product A", 2),
    (10, 103, "2023-06-10", "Product B", 3),
]


def transactions(spark):
    return spark.createDataFrame(TRANSACTIONS, "id int, customer int, day string, product string, quantity int")


def quantities(df):
    return {r.id: r.quantity for r in df.collect()}


def test_transactions_through_all_steps(spark):
    original = transactions(spark)
    raised = mutate.update_where(original, F.col("product") == "Product A", {"quantity": F.col("quantity") + 1})
    assert {i: q for i, q in quantities(raised).items() if i in (1, 3, 6, 9)} == {1: 3, 3: 4, 6: 3, 9: 3}
    kept = mutate.delete_where(raised, F.col("customer") == 101)
    assert sorted(quantities(kept)) == [2, 3, 5, 6, 7, 9, 10]
    merged = quantities(mutate.merge(kept, original, ["id"], update={"quantity": F.lit(0)}))
    assert {i for i, q in merged.items() if q == 0} == {2, 3, 5, 6, 7, 9, 10}
    assert {i: merged[i] for i in (1, 4, 8)} == {1: 2, 4: 1, 8: 5}


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v int")


def test_unknown_condition_does_not_match(spark, rows):
    df = frame(spark, [(1, None), (2, 5)])
    assert rows(mutate.delete_where(df, F.col("v") > 1)) == [(1, None)]
    assert rows(mutate.update_where(df, F.col("v") > 1, {"v": F.lit(0)})) == [(1, None), (2, 0)]


def test_merge_null_keys_never_match(spark, rows):
    target, source = frame(spark, [(None, 1), (1, 1)]), frame(spark, [(None, 2), (None, 3), (1, 9)])
    assert rows(mutate.merge(target, source, ["k"], update="all")) == [(None, 1), (None, 2), (None, 3), (1, 9)]


def test_merge_several_matches_raise(spark):
    target, source = frame(spark, [(1, 1)]), frame(spark, [(1, 2), (1, 3)])
    with pytest.raises(Exception, match="several source rows"):
        mutate.merge(target, source, ["k"], update="all").collect()


def test_merge_inserts_unmatched_duplicates(spark, rows):
    target, source = frame(spark, [(1, 1)]), frame(spark, [(2, 2), (2, 3)])
    assert rows(mutate.merge(target, source, ["k"], update="all")) == [(1, 1), (2, 2), (2, 3)]


def test_merge_keeps_repeated_target_keys(spark, rows):
    target, source = frame(spark, [(1, 1), (1, 2), (3, 3)]), frame(spark, [(1, 9)])
    assert rows(mutate.merge(target, source, ["k"], update="all")) == [(1, 9), (1, 9), (3, 3)]


def test_merge_condition_on_null_hash(spark, rows):
    target, source = frame(spark, [(1, None), (2, 2), (3, 3)]), frame(spark, [(1, 5), (2, None), (3, 4)])
    got = mutate.merge(target, source, ["k"], update="all", when=incoming("v") != F.col("v"))
    assert rows(got) == [(1, None), (2, 2), (3, 4)]


def test_merge_without_insert_and_with_empty_source(spark, rows):
    target = frame(spark, [(1, 1)])
    assert rows(mutate.merge(target, frame(spark, [(2, 2)]), ["k"], update="all", insert=None)) == [(1, 1)]
    assert rows(mutate.merge(target, frame(spark, []), ["k"], update="all")) == [(1, 1)]
    assert rows(mutate.merge(frame(spark, []), target, ["k"], update="all")) == [(1, 1)]


PAIRS = st.lists(st.tuples(st.integers(0, 8), st.integers(0, 3)), max_size=8, unique_by=lambda p: p[0])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=PAIRS, new=PAIRS)
def test_merge_like_a_dict(spark, old, new):
    got = mutate.merge(frame(spark, old), frame(spark, new), ["k"], update="all")
    assert sorted(tuple(r) for r in got.collect()) == sorted({**dict(old), **dict(new)}.items())


def test_update_from_sets_null_for_matched_rows_only(spark, rows):
    target, source = frame(spark, [(1, 1), (2, 2)]), frame(spark, [(1, None)])
    assert rows(mutate.update_from(target, source, ["k"], {"v": incoming("v")})) == [(1, None), (2, 2)]


# --- type-2 dimensions ---------------------------------------------------------------------------

SPEC = scd2.Type2(key="id", tracked=("name", "office"))
START, RUN, LATER = "2020-01-01 00:00:00", "2021-01-01 00:00:00", "2022-01-01 00:00:00"


def people(spark, *records):
    return spark.createDataFrame(list(records), "id int, name string, office string")


FIRST = [(1, "Ann", "A"), (2, "Bob", "B"), (3, None, "C")]
SECOND = [(1, "Ann", "Z"), (2, "Bob", "B"), (3, "Cy", "C"), (4, "Dee", "D")]


@pytest.fixture()
def dimension(spark):
    return scd2.initial_load(people(spark, *FIRST), SPEC, START)


def by_merge(dim, source, spec, run):
    return scd2.apply_merge(dim, scd2.upsert_rows(dim, source, spec, run), spec)


@pytest.mark.parametrize("apply", [scd2.apply_snapshot, by_merge])
def test_changes_make_one_version_each(spark, dimension, apply):
    after = apply(dimension, people(spark, *SECOND), SPEC, RUN)
    got = sorted((r.id, r.name or "", r.office, r.start_date.year, r.end_date.year, r.is_current) for r in after.collect())
    assert got == [
        (1, "Ann", "A", 2020, 2021, False),
        (1, "Ann", "Z", 2021, 2100, True),
        (2, "Bob", "B", 2020, 2100, True),
        (3, "", "C", 2020, 2021, False),
        (3, "Cy", "C", 2021, 2100, True),
        (4, "Dee", "D", 2021, 2100, True),
    ]
    assert after.select("sk").distinct().count() == 6
    chains = keys.version_chains(after, "id", "start_date", "end_date", "is_current")
    assert chains.where("NOT is_sound").count() == 0


@pytest.mark.parametrize("apply", [scd2.apply_snapshot, by_merge])
def test_second_run_changes_nothing(spark, dimension, rows, apply):
    source = people(spark, *SECOND)
    once = apply(dimension, source, SPEC, RUN)
    assert rows(apply(once, source, SPEC, LATER)) == rows(once)


def test_both_forms_agree(spark, dimension, rows):
    source = people(spark, *SECOND)
    assert rows(by_merge(dimension, source, SPEC, RUN)) == rows(scd2.apply_snapshot(dimension, source, SPEC, RUN))


def test_missing_keys_stay_open_unless_asked(spark, dimension):
    source = people(spark, FIRST[0])
    assert scd2.apply_snapshot(dimension, source, SPEC, RUN).where("is_current").count() == 3
    closed = scd2.apply_snapshot(dimension, source, SPEC, RUN, close_missing=True)
    assert [r.id for r in closed.where("is_current").collect()] == [1]


def test_concat_hash_does_not_see_nulls(spark):
    spec = replace(SPEC, hash_policy="concat")
    dim = scd2.initial_load(people(spark, *FIRST), spec, START)
    verdicts = {r.id: r.change for r in scd2.detect_changes(dim, people(spark, *SECOND), spec).collect()}
    assert verdicts == {1: "changed", 2: "unchanged", 3: "unchanged", 4: "new"}


def test_empty_dimension_takes_all(spark, dimension):
    got = scd2.apply_snapshot(dimension.limit(0), people(spark, *FIRST), SPEC, RUN)
    assert got.where("is_current").count() == 3


def test_expire(spark, dimension):
    closed = mutate.expire(dimension, people(spark, FIRST[0], FIRST[0]), "id", "end_date", "is_current", RUN)
    assert sorted((r.id, r.is_current, r.end_date.year) for r in closed.collect()) == [
        (1, False, 2021), (2, True, 2100), (3, True, 2100),
    ]


# --- versioned tables ----------------------------------------------------------------------------


def test_log_on_disk(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    day = "2024-01-0{} 00:00:00"
    commits = [([(1, 1), (2, 2), (3, 3)], "I"), ([(1, 10)], "U"), ([(2, 2)], "D"), ([(2, 20)], "I")]
    for version, (changed, op) in enumerate(commits):
        log = versioned.changes(frame(spark, changed), version, day.format(version + 1), op)
        versioned.append_changes(log, path)
    log = versioned.read_log(spark, path)
    assert rows(versioned.state_at(log, ["k"], version=0)) == [(1, 1), (2, 2), (3, 3)]
    assert rows(versioned.state_at(log, ["k"], version=2)) == [(1, 10), (3, 3)]
    assert rows(versioned.state_at(log, ["k"])) == [(1, 10), (2, 20), (3, 3)]
    assert rows(versioned.state_at(log, ["k"], timestamp="2024-01-02 12:00:00")) == [(1, 10), (2, 2), (3, 3)]
    history = [(r.version, r.commit_ts, r.inserted, r.updated, r.deleted) for r in versioned.history(log).collect()]
    assert sorted(history)[1] == (1, dt.datetime(2024, 1, 2), 0, 1, 0)


# --- guards of merges and type-2 loads -------------------------------------------------------------


@pytest.mark.parametrize("small", [False, True])
def test_merge_guard_is_part_of_every_result(spark, small):
    target, source = frame(spark, [(1, 1), (2, 2)]), frame(spark, [(1, 5), (1, 6)])
    merged = mutate.merge(target, source, ["k"], update="all", small=small)
    for use in (lambda d: d.count(), lambda d: d.select("k").collect()):
        with pytest.raises(Exception, match="several source rows"):
            use(merged)
    assert mutate.merge(target, source, ["k"], small=small).count() == 2


@pytest.mark.parametrize("small", [False, True])
def test_merge_forms_agree(spark, rows, small):
    target = frame(spark, [(1, 1), (2, 2), (None, 3), (4, 4)])
    source = frame(spark, [(1, 10), (3, 30), (3, 31), (None, 9), (4, 40)])
    got = mutate.merge(target, source, ["k"], update="all", only_source=F.col("v") < 40, only_target=F.col("v") > 0, small=small)
    assert rows(got) == sorted(
        [(1, 10), (2, 2), (None, 3), (4, 4), (3, 30), (3, 31), (None, 9), (4, 40)], key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


def test_merge_reads_the_target_once(spark, plan, tmp_path):
    for name in ("target", "source"):
        spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # paths are cut short otherwise
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        text = plan(mutate.merge(target, source, ["k"], update="all"))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert text.count("/target]") == 1 and text.count("/source]") == 2
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_snapshot_guards(spark, dimension):
    for wrong, message in ((people(spark, FIRST[0], FIRST[0]), "key twice"), (people(spark, (None, *FIRST[0][1:])), "without key")):
        with pytest.raises(Exception, match=message):
            scd2.apply_snapshot(dimension, wrong, SPEC, RUN).count()
        with pytest.raises(Exception, match=message):
            by_merge(dimension, wrong, SPEC, RUN).count()
    with pytest.raises(Exception, match="not after the start"):
        scd2.apply_snapshot(dimension, people(spark, *SECOND), SPEC, START).count()


def test_versions_without_a_flag_stay(spark, dimension):
    odd = dimension.withColumn("is_current", F.when(F.col("id") != 2, F.col("is_current")))
    got = scd2.apply_snapshot(odd, people(spark, FIRST[0]), SPEC, RUN)
    assert got.count() == dimension.count() and got.where("is_current is null").count() == 1


def test_second_run_of_a_snapshot_changes_nothing(spark, dimension, rows):
    once = scd2.apply_snapshot(dimension, people(spark, *SECOND), SPEC, RUN)
    again = scd2.apply_snapshot(once, people(spark, *SECOND), SPEC, "2030-01-01 00:00:00")
    assert rows(again) == rows(once)


def test_values_that_share_a_hash_still_differ(spark):
    schema = "id long, a string, b string"
    spec = scd2.Type2(key="id", tracked=("a", "b"))
    dim = scd2.initial_load(spark.createDataFrame([(1, "a|b", "c"), (2, None, "x")], schema), spec, "2020-01-01 00:00:00")
    later = spark.createDataFrame([(1, "a", "b|c"), (2, "", "x")], schema)
    assert {r.change for r in scd2.detect_changes(dim, later, spec).collect()} == {"changed"}
