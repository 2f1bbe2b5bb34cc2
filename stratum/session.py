"""Session helpers: settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings the operators depend on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # zone-less timestamps must not shift when turned into epoch seconds
    "spark.sql.session.timeZone": "UTC",
}

# Tuning defaults applied only by ``build_session`` (tests, bench); a cluster
# session keeps its own values.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator assumes (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def build_session(master: str | None = None, partitions: int = 8, app: str = "stratum") -> SparkSession:
    """Session for tests and the local bench: ``local[N]`` with a small shuffle width."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared storage).  A session that names
    none gets a folder of its own only if it runs in one process (``local`` master: driver and
    executors are the same); on a cluster it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = os.path.join(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"), "_stratum_scratch")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written intermediate table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/stratum-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def release_scratch(spark: SparkSession) -> int:
    """Delete every intermediate table of this application so far; returns how many paths there were.

    DataFrames that read them stop working: call it when a job's results are written.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Survives executor loss like a reliable checkpoint, and unlike an RDD
    checkpoint the re-reads keep column pruning and filter pushdown (later
    jobs that need only keys and labels do not read the text).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # known schema: no footer inference
