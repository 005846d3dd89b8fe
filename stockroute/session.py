"""Session helpers: a local session for tests and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stockroute") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(shuffle_partitions: int = 2000) -> dict[str, str]:
    """Settings this library is designed around on a large cluster.

    Shuffle partitions start high and AQE coalesces them to the advisory
    size at run time; skewed join partitions are split; Arrow carries the
    only Python step (per-depot tours).  ``spark.checkpoint.dir`` must be set
    by the deployment to shared storage.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
        "spark.sql.session.timeZone": "UTC",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always honoured.
    Only when it is unset and the master is local (tests, benches) a fresh
    scratch folder is made; a cluster without the setting is an error because
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getConf().get(_CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(for example an object-store or HDFS folder)")
    path = tempfile.mkdtemp(prefix="stockroute-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back, so that
    later readers scan only the columns they need and no lineage is kept."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted_table(df: DataFrame, name: str, **measures) -> tuple[DataFrame, dict]:
    """``shared_table`` plus what the write saw of its rows: their number (``rows``)
    and the given aggregate columns, observed in passing instead of by a scan of their own."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    seen = Observation(name)
    out = shared_table(df.observe(seen, F.count(F.lit(1)).alias("rows"),
                                  *[c.alias(k) for k, c in measures.items()]), name)
    return out, seen.get
