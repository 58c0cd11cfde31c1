"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "cellcast", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it: there a fresh temporary folder is set, once per session. On
    a cluster a machine-local folder would vanish with its executor, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="cellcast-")
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    This cuts the lineage the durable way: later jobs read parquet with column pruning, and a lost
    executor costs a re-read instead of a recomputation of everything before. With ``partition_by`` (columns
    of few values, such as dates) later filters on these columns read only their folders.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if partition_by:  # rows are gathered by these columns first, else every task would write a file to each folder
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out = out.select(*df.columns) if partition_by else out
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``staged`` that nothing reads any more: what was made from them must be staged itself.

    Frames that are not from ``staged`` are left alone.
    """
    for df in tables:
        path = getattr(df, "_staged_at", None)
        if path:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
