"""Session helper for local work, and the one way the package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cores: int | str = 8, app: str = "opinia", memory: str = "12g") -> SparkSession:
    """A local session for tests and bench.py; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a session on a local master gets a folder of its own, once. On a
    cluster there is no folder that all executors are known to see, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return str(configured)
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="opinia-")
    sc.setCheckpointDir(folder)
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Scope:
    """Removes the tables that :func:`materialize` wrote inside it, when it is left.

    Results that read these tables have to be written or collected before that.
    """

    _open: list[Scope] = []

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def __enter__(self) -> Scope:
        Scope._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scope._open.remove(self)
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str, schema: StructType | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used for what several branches or passes of one job read: corpus-level aggregates
    (vocabulary, bigram counts, candidates), which each branch would otherwise compute from
    the text again, and training vectors, which learners pass over many times. The
    written table outlives executors and keeps column pruning and size statistics, which a
    cached or checkpointed RDD would not. An open :class:`Scope` removes it at its end. ``schema``
    is another type for columns of the same storage form.

    ``by`` names a column to bucket the table by, one bucket for each shuffle partition: what is computed
    from it by that column can be joined back to it without moving it again. ``df`` should be dealt by
    that column already, below whatever makes its rows larger.
    """
    spark = df.sparkSession
    base = scratch_dir(spark).rstrip("/")
    path = f"{base}/opinia/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if by:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"opinia_{uuid.uuid4().hex}"
        df.write.bucketBy(parts, by).option("path", path).format("parquet").saveAsTable(table)
    else:
        df.write.parquet(path)
    if Scope._open:
        Scope._open[-1].paths.append(path)
        if by:
            Scope._open[-1].tables.append(table)
    if by:
        return spark.table(table)
    return spark.read.schema(schema or df.schema).parquet(path)
