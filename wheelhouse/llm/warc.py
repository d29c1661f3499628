"""Web archive (WARC) files: writing page records, and reading them back by boundary-chain verification.

Writing: each page is one record with its HTML as payload.  Of pages with equal payloads of at least
:data:`LEAST_REVISIT` bytes the one with the largest id is a response; the others are revisits that refer to it and carry
no payload.  Digests and lengths always are those of the full payload.

Reading: tasks cut the archives at every occurrence of the record magic, also where a payload merely contains it, and
emit for each the offset where a record would begin and, from its header, where its successor would.  Offsets within a
file come from sums over the blocks before.  Only records on the chain that starts at offset 0 are real; the chain is
followed by pointer jumping, which doubles the reach of every pointer in each round, so that a file of n records takes
about log2(n) rounds of light joins.  Records whose payload holds the magic are put together from their pieces.

A null HTML is an empty payload; a null url is left out of the header; line ends in a url are percent-encoded.  Pages
with one id are separate records; if it is the largest of their group, all of them are responses.  A null page_id
stays null.  Empty tables and archives give no rows.  Very long payloads are one record like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wheelhouse.llm.scratch import written
from wheelhouse.llm.shipping import ship

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
SPAN_BYTES = 1 << 20  # of a file, in which pieces and the records they belong to are brought together
LEAST_REVISIT = 1000
BROADCAST_ROWS = 100_000  # of 60 bytes: repeated digests that are sent to all tasks; more are joined by a shuffle
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_FILE = ["file", "block"]


def page_records(pages: DataFrame) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to, which replace columns of these names."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.drop("record_type", "refers_to")
    own = pages.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": F.sha1(payload)})
    repeated = (
        own.where(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("__first_page"), F.count("*").alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    repeated = written(repeated, "repeated")
    on = ["payload_digest", "payload_bytes"]
    if repeated.count() <= BROADCAST_ROWS:
        joined = own.join(F.broadcast(repeated), on, "left")
    else:
        salted = repeated.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        joined = own.withColumn("__salt", salt).join(salted, [*on, "__salt"], "left").drop("__salt")
    revisit = F.col("__first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first_page"))
    return joined.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("__first_page")),
        }
    ).drop("__first_page")


def _header(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per page below ``path``; the writer's line separator is the gap after each record."""
    records = page_records(pages.select("page_id", "url", "html"))
    revisit = F.col("record_type") == "revisit"
    payload = F.when(revisit, F.lit("")).otherwise(F.coalesce("html", F.lit("")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _header("WARC-Target-URI", url),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(payload).cast("string")),
        F.lit("\r\n"),
        payload,
    )
    records.select(record.alias("value")).write.option("lineSep", GAP).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic: (file, block, piece), in the order of the files within each block."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece")
    )


def _with_places(pieces: DataFrame) -> DataFrame:
    """Adds ``local``: where a piece begins, counted from the first piece of its block; needs ``bytes``."""
    kept = pieces.schema.fieldNames()
    f, b, n = (kept.index(name) for name in ("file", "block", "bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at = None, 0
        for batch in batches:
            local = []
            for file, block, size in zip(*(batch.column(i).to_pylist() for i in (f, b, n))):
                if (file, block) != current:
                    current, at = (file, block), 0
                local.append(at)
                at += size + len(MAGIC)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], names=[*kept, "local"])

    ship(pieces.sparkSession)
    return pieces.mapInArrow(run, pieces.withColumn("local", F.lit(0).cast("long")).schema)


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _page(value: Column) -> Column:
    return F.regexp_extract(value, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")


def record_candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per magic, real or not: where it stands, what its header says, and the digest of its own payload.

    ``start`` and ``next`` are offsets in the file; ``next`` is null where there is no header with a length.
    ``whole`` tells that the piece ends where the record does.
    """
    raw = F.col("piece").cast("binary")
    header = F.substring_index("piece", GAP, 1)
    size, length = F.octet_length("piece").cast("long"), _field(header, "Content-Length").try_cast("long")
    head = F.octet_length(header).cast("long")
    complete = (size > head) & (length >= 0)
    read = _pieces(spark, path).select(
        *_FILE,
        size.alias("bytes"),
        F.when(complete, head + len(GAP)).alias("head"),
        F.when(complete, length).alias("length"),
        # The last record of a file, like every other, ends in the gap.
        (complete & (size == head + length + 2 * len(GAP))).alias("whole"),
        F.sha1(F.substring(raw, (head + len(GAP) + 1).cast("int"), length.cast("int"))).alias("sha1"),
        _field(header, "WARC-Type").alias("record_type"),
        _page(_field(header, "WARC-Record-ID")).alias("page_id"),
        _page(_field(header, "WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(_field(header, "WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("said_digest"),
        _field(header, "X-Payload-Length").try_cast("long").alias("said_bytes"),
    )
    placed = written(_with_places(read), "pieces")
    blocks = placed.groupBy(*_FILE).agg(F.sum(F.col("bytes") + len(MAGIC)).alias("size"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = blocks.select(*_FILE, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    start = F.col("base") + F.col("local") - len(MAGIC)
    return (
        placed.join(bases, _FILE)
        .withColumn("start", start)
        .where("start >= 0")  # what stands before the first magic of a file is no record
        .withColumn("next", F.col("start") + len(MAGIC) + F.col("head") + F.col("length") + len(GAP))
    )


def reachable(links: DataFrame) -> DataFrame:
    """(file, start) of the records on the chain from offset 0, by pointer jumping over (file, start, next)."""
    jumps = links.where("next is not null").select("file", "start", "next")
    seen = written(links.where("start = 0").select("file", "start").distinct(), "chain")
    starts = links.select("file", F.col("start").alias("next")).distinct()
    jumps = written(jumps.join(starts, ["file", "next"], "left_semi").select("file", "start", "next"), "jumps")
    while jumps.limit(1).count():
        ahead = seen.join(jumps, ["file", "start"]).select("file", F.col("next").alias("start"))
        seen = written(seen.union(ahead), "chain")
        onward = jumps.toDF("file", "next", "then")
        jumps = written(jumps.join(onward, ["file", "next"]).select("file", "start", F.col("then").alias("next")), "jumps")
    return seen


def _joined_payloads(spark: SparkSession, path: str, found: DataFrame, broken: DataFrame) -> DataFrame:
    """(file, start, payload) of the records whose payload holds the magic."""
    def span(offset: str) -> Column:
        return F.floor(F.col(offset) / SPAN_BYTES)

    # Records do not overlap, so that a piece stands in one at most; both meet in the spans of the file they touch.
    owners = broken.select("file", F.col("start").alias("owner"), F.col("next").alias("until"))
    owners = owners.withColumn("span", F.explode(F.sequence(span("owner"), span("until"))))
    owned = found.withColumn("span", span("start")).join(owners, ["file", "span"])
    inside = (F.col("start") >= F.col("owner")) & (F.col("start") < F.col("until"))
    wanted = owned.where(inside).select(*_FILE, "local", "start", "owner")
    pieces = _with_places(_pieces(spark, path).select(*_FILE, F.col("piece").cast("binary").alias("piece"), F.octet_length("piece").cast("long").alias("bytes")))
    parts = pieces.join(wanted, [*_FILE, "local"]).select("file", "owner", "start", F.concat(F.encode(F.lit(MAGIC), "UTF-8"), "piece").alias("piece"))
    whole = parts.groupBy("file", F.col("owner").alias("start")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", F.hex("piece").alias("hex")))), lambda p: p["hex"]), "").alias("hex")
    )
    heads = broken.select("file", "start", "head", "length")
    begin = (F.col("head") + len(MAGIC) + 1).cast("int")
    return whole.join(heads, ["file", "start"]).select("file", "start", F.substring(F.unhex("hex"), begin, F.col("length").cast("int")).alias("payload"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every real record below ``path``."""
    found = written(record_candidates(spark, path), "candidates")
    real = written(found.join(reachable(found.select("file", "start", "next")), ["file", "start"]), "records")
    broken = real.where("not whole and length is not null and record_type <> 'revisit'")
    if broken.limit(1).count():
        joined = _joined_payloads(spark, path, found, broken).select("file", "start", F.sha1("payload").alias("joined_sha1"))
        real = real.join(joined, ["file", "start"], "left").withColumn("sha1", F.coalesce("joined_sha1", "sha1"))
    revisit = F.col("record_type") == "revisit"
    return real.select(
        "page_id",
        F.when(revisit, F.col("said_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("said_digest")).otherwise(F.col("sha1")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
