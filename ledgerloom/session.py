"""Session settings that every job relies on."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Settings the library needs regardless of cluster size.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerloom",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests, bench and the entry point (UI off, no ports beyond Spark's own)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset a local master gets a scratch folder of its own; on a cluster that
    would be a different disk for every executor, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/ledgerloom/steps/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def check_session(spark: SparkSession) -> None:
    """Warn about settings that results or plans rely on; the caller's session is left as it is."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, v) != v:
            warnings.warn(f"{k} is {spark.conf.get(k)}; this library is built for {v}", stacklevel=2)
