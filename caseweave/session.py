"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

TASK_CHARS = 12_000_000  # see spread


def build_session(app: str = "caseweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``master`` is for local runs, a cluster submits its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where the setting is absent, a folder below Spark's warehouse stands in, on a local master only.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    The later plan is a plain scan: columns are pruned, sizes are known, and lost executors take nothing with them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that no later plan reads, as when what was made of them is stored itself."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Continue from a table in the shared folder; survives the loss of executors."""
    return stored(df, "cut")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table written by a job."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *key: str, text: str | None = None) -> DataFrame:
    """Give a scan with fewer splits than cores one partition per core; a scan with enough splits stays as it is.

    With ``text`` no partition is meant to hold more than ``TASK_CHARS`` characters of that column, for steps whose
    memory grows with the texts of a task; its lengths are summed in a job, and more partitions than cores are made for them.
    ``key`` should be unique per row, so that no partition gets more than its share.
    Call it on a plain scan or on a table from :func:`cut_lineage`, where the number of splits is known without
    running a job.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if text is not None:
        chars = df.agg(F.sum(F.length(text))).first()[0] or 0
        wanted = max(wanted, -(-chars // TASK_CHARS))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, *key)
