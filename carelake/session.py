"""Session helpers: a tuned builder for stand-alone use and the shared scratch folder.

Library functions never change the configuration of a session they are handed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def local_session(cores: int | str = "*", app: str = "carelake", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    parallelism = "8" if cores == "*" else str(cores)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": parallelism,
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        # no call-site capture per column expression; it costs more than building the plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def cluster_settings() -> dict[str, str]:
    """Settings to pass to ``spark-submit`` for large runs; all are plain Spark options.

    AQE sizes reducers from measured bytes, so the initial partition number is set high and
    coalesced; skewed join partitions are split even where that costs one more exchange.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="carelake-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def observed(seen: Observation, names: Iterable[str], source: DataFrame | None = None) -> dict[str, int]:
    """Counts an observation collected while its rows were written.

    The optimizer removes an observation together with an input that it proves empty; reading it
    then fails. ``source`` is what was observed: the counts are 0 if it is shown to have no rows,
    and any other failure is raised.
    """
    try:
        counts = seen.get
    except Py4JJavaError:
        if source is None or not source.isEmpty():
            raise
        counts = {}
    return {name: int(counts.get(name) or 0) for name in names}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file system Spark knows holds something at the path."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/carelake/{label}-{uuid.uuid4().hex}"
