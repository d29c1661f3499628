"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package counts on.  All are runtime SQL settings, so they can be applied
# to a session somebody else has started.  Partition counts and memory stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join partition that holds a hot key is split, also where an aggregation on the same key follows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a running session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "wheelhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A tuned session; ``master`` and ``conf`` are for local runs, a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else one beside the tables of the warehouse.

    Both are places that every executor reaches; a folder of one machine is never chosen here.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    return shared.rstrip("/") if shared else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder of this application below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to scratch folders; whoever owns the run calls it at its end."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
