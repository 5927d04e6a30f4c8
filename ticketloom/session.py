"""Session defaults, lineage cuts and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "ticketloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` entries win.

    On a cluster leave ``master`` unset and let the submit command decide it, together
    with ``spark.sql.shuffle.partitions`` and ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(SESSION_DEFAULTS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.update({
                "spark.driver.host": "127.0.0.1",
                "spark.driver.bindAddress": "127.0.0.1",
                "spark.sql.shuffle.partitions": "8",
                "spark.driver.memory": "12g",
            })
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; only local sessions get one made up."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="ticketloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def is_folder(spark: SparkSession, path: str) -> bool:
    """Asked of the store that holds the path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.exists(path) and store.getFileStatus(path).isDirectory()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder; :func:`clear_scratch` removes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables this process wrote to the shared folder; call it when no result is read any more."""
    gone, conf = 0, spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete one written table that no result reads any more."""
    _SCRATCH.remove(path)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in reliable storage and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as parquet in the shared folder, with ``options`` of the writer, and read it back.

    Unlike :func:`settle` the result keeps column pruning and pushed filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SMALL_ROWS = 20_000
SMALL_BYTES = 8_000_000


def small_copy(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame | None:
    """A local copy of a table of at most so many rows and bytes, to be broadcast; ``None`` if it is larger."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def measured(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Turn a table that proves small into a broadcastable local one.

    For class tables, cut points and bucket counts: read up to ``max_rows`` rows, checked by
    rows and by bytes, then broadcast, which spares the large side a shuffle. A larger table
    is written to shared storage, so what was computed to find out is not computed again, and is
    joined by shuffle.
    """
    kept = df.persist()
    try:
        small = small_copy(kept, max_rows, max_bytes)
        return settle_table(kept, "measured") if small is None else F.broadcast(small)
    finally:
        kept.unpersist()
