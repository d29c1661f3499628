from __future__ import annotations

import hashlib
import random

import pytest

from wheelhouse.llm import warc
from wheelhouse.session import scratch_dir

FAKE = (
    "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"
)


def expected(pages):
    out = []
    groups = {}
    for page, _, html in pages:
        body = (html or "").encode()
        if len(body) >= 1000:
            key = hashlib.sha1(body).hexdigest()
            groups[key] = max([x for x in (groups.get(key), page) if x is not None], default=None)
    for page, _, html in pages:
        body = (html or "").encode()
        key = hashlib.sha1(body).hexdigest()
        first = groups.get(key)
        revisit = first is not None and first != page
        out.append((page, len(body), key, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def archived(spark, pages, parts=3):
    path = scratch_dir(spark, "warc-test")
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)
    warc.write_archive(df, path)
    return sorted((tuple(r) for r in warc.read_archive(spark, path).collect()), key=str)


PAGES = [
    (1, "http://a.example", "<p>é</p>" * 400),
    (2, None, "<p>é</p>" * 400),
    (5, "http://b.example/\r\nX: y", "<p>é</p>" * 400),
    (3, "u", None),
    (4, "u", ""),
    (6, "u", "x" * 999),
    (7, "u", "x" * 999),
    (8, "u", "x" * 1000),
    (8, "u", "x" * 1000),
    (9, "u", FAKE + "y" * 1200),
    (10, "u", "before " + FAKE + FAKE + "\r\n\r\n"),
    (11, "u", "WARC/1.0\r\n"),
    (12, "u", "\r\n\r\n" + "WARC/1.0\r\nContent-Length: 99999\r\n\r\nrest"),
    (None, "u", "z" * 1500),
    (13, "u", "WARC/1.0\r\n" + "long " * 200_000),
    (-7, "u", "minus"),
]


@pytest.mark.parametrize("block", ["128m", "700"])
def test_round_trip_and_magic_in_payloads(spark, block):
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pages = PAGES if block == "128m" else [p for p in PAGES if p[0] != 13]
        assert archived(spark, pages, 2) == expected(pages)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_salted_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert archived(spark, PAGES) == expected(PAGES)


def test_long_chain_and_extra_columns(spark):
    rng = random.Random(5)
    pages = [(i, f"u{i}", "<b>" * rng.randint(0, 600)) for i in range(500)]
    assert archived(spark, pages, 1) == expected(pages)
    df = spark.createDataFrame([(1, "u", "h", 3, 4)], "page_id long, url string, html string, refers_to int, mine int")
    assert warc.page_records(df).select("page_id", "mine", "record_type", "refers_to").first() == (1, 4, "response", None)
    path = scratch_dir(spark, "warc-test")
    warc.write_archive(df, path)
    assert warc.read_archive(spark, path).count() == 1


def test_empty_table(spark):
    assert archived(spark, [], 1) == []


@pytest.mark.parametrize("span", [1 << 20, 64])
def test_payloads_are_joined_without_a_window_over_the_file(spark, plan, monkeypatch, span):
    monkeypatch.setattr(warc, "SPAN_BYTES", span)
    pages = [(i, f"http://h/{i}", f"<p>{i}</p>" + (FAKE * (1 + i % 3) + "x" * 300 if i % 2 else "")) for i in range(12)]
    path = scratch_dir(spark, "warc-spans")
    warc.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), path)
    found = warc.written(warc.record_candidates(spark, path), "candidates")
    broken = found.where("page_id <> 999 and not whole and length is not null")
    joined = warc._joined_payloads(spark, path, found, broken)
    assert "Window" not in plan(joined)
    assert sorted(bytes(r.payload).decode() for r in joined.collect()) == sorted(html for i, _, html in pages if i % 2)
    assert sorted((tuple(r) for r in warc.read_archive(spark, path).collect()), key=str) == expected(pages)
