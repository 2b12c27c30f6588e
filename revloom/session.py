"""Session settings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on.  UTC keeps date derivations stable; the skew
# settings let the engine split a hot shuffle partition even when a later aggregate
# would otherwise forbid it.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "revloom", cpus: str = "*", **overrides: str) -> SparkSession:
    """A local session for tests and benchmarks.  Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_named_root: str | None = None


def name_scratch_root(path: str) -> None:
    """Name the scratch folder for sessions that do not set ``spark.checkpoint.dir``."""
    global _named_root
    _named_root = path


def has_scratch(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None) or _named_root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting the caller has to name a folder; the library never picks one,
    because executors could not read a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _named_root
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root.rstrip('/')}/revloom/{name}-{uuid.uuid4().hex}"


def stored_copy(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch space and read back: its lineage ends there, and what it read may change."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
