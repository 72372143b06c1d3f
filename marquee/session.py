"""SparkSession construction and the shared scratch location.

Every job here assumes a UTC session time zone (the event store is UTC by
contract), AQE on, and dynamic partition overwrite so that per-day rewrites
only touch the days they produce.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of the fixpoints and upserts are dropped once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "marquee",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs; on a cluster the launcher's
    master and resources win, we only add the semantic settings above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Settings the results depend on; safe to call on a session we did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per
    application: functions of Python operators are pickled by module name, so
    the workers must be able to import it wherever they were started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="marquee-src-"), "marquee_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("marquee", os.path.relpath(full, here)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    A cluster names it in ``spark.checkpoint.dir``; we read it from the
    session.  Only when it is unset and the master is local (tests, bench)
    do we pick a fresh folder under /tmp ourselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="marquee-ckpt-", dir="/tmp")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in a fresh folder of the shared scratch space,
    read back: computed once, lineage cut, values frozen against recomputation
    after a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
