"""The registered queries over ``embeddings`` and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelhouse.llm import centroids, nn_descent, part_codes
from wheelhouse.llm.registry import query, table


@query("op11_nn_descent")
def op11_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 rows of the largest inner product for every twentieth row."""
    found = nn_descent.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.select(F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("id").cast("long").alias("vec_id"), "score")


#: Rows whose components are all finite, one row for each component; the remainder of a division is brought to 0 or more.
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _floor_division(total: str, n: str) -> str:
    return f"CAST(({total} - ((({total}) % {n}) + {n}) % {n}) // {n} AS BIGINT)"


def _part_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS u,
         row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))) - 1 AS place
  FROM embeddings WHERE {_FINITE}
),
wide AS (SELECT greatest(1, -(-max(len(u)) // {parts})) AS d FROM kept),
cells AS MATERIALIZED (
  SELECT place, p.part, i.pos, coalesce(u[p.part * d + i.pos + 1], 0) AS x
  FROM kept, wide, range({parts}) AS p(part), range(d) AS i(pos)
),
book0 AS MATERIALIZED (SELECT part, place AS entry, pos, x AS c FROM cells WHERE place < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
far{i} AS MATERIALIZED (
  SELECT place, part, entry, sum((x - c) * (x - c)) AS dist FROM cells JOIN book{i} USING (part, pos) GROUP BY place, part, entry
),
near{i} AS MATERIALIZED (
  SELECT place, part, entry, dist FROM far{i}
  QUALIFY row_number() OVER (PARTITION BY place, part ORDER BY dist, entry) = 1
)""")
        if i < rounds:
            total = "sum(x)"
            steps.append(f"""
moved{i} AS (
  SELECT part, entry, pos, {_floor_division(total, 'count(*)')} AS c FROM cells JOIN near{i} USING (place, part) GROUP BY part, entry, pos
),
book{i + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN moved{i} m USING (part, entry, pos)
)""")
    steps.append(f"""
coded AS (
  SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM near{rounds} GROUP BY place
)""")
    return ",".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (place)
"""


@query("op12_part_codes", _part_codes_sql())
def op12_part_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of eight parts, sixteen entries each, for all vectors."""
    coded, books = part_codes.compressed(table(spark, folder, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(part_codes.digest(books)).alias("codebooks_sha256"))


def _centroids_sql(count: int = 8, rounds: int = 10, scale: int = 1024, width: int = 64, seed: str = "3") -> str:
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS u,
         row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)) NULLS LAST,
                            list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))) - 1 AS place
  FROM embeddings WHERE {_FINITE} AND len(embedding) = {width}
),
cells AS MATERIALIZED (SELECT place, i.pos, u[i.pos + 1] AS x FROM kept, range({width}) AS i(pos)),
mid0 AS MATERIALIZED (SELECT place AS cluster, pos, x AS c FROM cells WHERE place < {count})"""]
    for i in range(rounds + 1):
        steps.append(f"""
far{i} AS MATERIALIZED (
  SELECT place, cluster, sum((x - c) * (x - c)) AS dist FROM cells JOIN mid{i} USING (pos) GROUP BY place, cluster
),
near{i} AS MATERIALIZED (
  SELECT place, cluster, dist FROM far{i} QUALIFY row_number() OVER (PARTITION BY place ORDER BY dist, cluster) = 1
)""")
        if i < rounds:
            total = "sum(x)"
            steps.append(f"""
moved{i} AS (
  SELECT cluster, pos, {_floor_division(total, 'count(*)')} AS c FROM cells JOIN near{i} USING (place) GROUP BY cluster, pos
),
mid{i + 1} AS MATERIALIZED (
  SELECT cluster, pos, coalesce(m.c, b.c) AS c FROM mid{i} b LEFT JOIN moved{i} m USING (cluster, pos)
)""")
    steps.append(f"""
named AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM mid{rounds} GROUP BY cluster)""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN near{rounds} USING (place) JOIN named USING (cluster)
"""


@query("op13_centroids", _centroids_sql())
def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of all vectors of 64 components."""
    found, middles = centroids.clustered(table(spark, folder, "embeddings"))
    names = F.array(*[F.lit(name) for name in centroids.digests(middles)]).cast("array<string>")
    return found.withColumn("centroid_sha256", F.get(names, F.col("cluster")))
