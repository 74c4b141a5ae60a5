"""Spark session and lineage helpers.

The checkpoint folder, where all intermediate data goes, is the one that
``spark.checkpoint.dir`` names. A session without that setting gets a folder
of its own below the warehouse, which the driver and the executors share.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins/partition counts at
# runtime and splits skewed shuffle partitions; Arrow carries the few
# Python stages.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files are deleted once their DataFrame is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "wryspark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``SparkContext`` at the shared checkpoint folder and return it:
    ``spark.checkpoint.dir`` if set, else a new folder in the warehouse."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints/{uuid.uuid4().hex}"
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``wryspark`` importable in Python workers (UDFs, ``mapInPandas``,
    ``applyInPandas``): zip the package once per application and register
    it with ``addPyFile``, as ``--py-files`` would."""
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="wryspark-pkg-"), "wryspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def small_side(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """A table written once and, if it has at most ``max_rows`` rows, marked
    for a broadcast; larger ones are left to the join's own choice."""
    from pyspark.sql import functions as F
    df = cut_lineage(df)
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
