"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_FALLBACK: dict = {}     # sessions where the conf could not be set (tests only: the cluster sets it)

#: Whole texts come from Parquet in so many rows and go to Python in so many bytes at once (Spark: 4096 rows, 64 MB). A
#: task holds a few such batches beside its heap, and memory that an executor has once taken for them it mostly keeps.
BATCH_CONFS = {"spark.sql.execution.arrow.maxBytesPerBatch": 2 << 20, "spark.sql.parquet.columnarReaderBatchSize": 512}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off).

    On a cluster the session comes from the launcher; this is for tests and the bench.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir``. Only on a local master (tests) is a fresh folder made and
    set where it is unset; on a cluster executors would each write to their own disk, so that is an error.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or _FALLBACK.get(id(spark))
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share (master {master or 'unknown'})")
        path = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        _FALLBACK[id(spark)] = path
        try:
            spark.conf.set(CHECKPOINT_CONF, path)
        except Exception:  # noqa: BLE001 - a session may refuse core confs; keep the folder here
            pass
    try:
        spark.sparkContext.setCheckpointDir(path)        # classic sessions; Connect has no context
    except Exception:  # noqa: BLE001
        pass
    return path


def small_batches(spark: SparkSession) -> None:
    """Bound the session's batches by ``BATCH_CONFS``; smaller settings stay. Batches have no influence on results."""
    for key, most in BATCH_CONFS.items():
        number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)i?b?", spark.conf.get(key).strip().lower()).groups()
        if not 0 < int(number) << (10 * " kmgt".index(unit or " ")) <= most:
            spark.conf.set(key, str(most))


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    One computation (``Dataset.checkpoint`` would compute the plan twice), columnar, and the
    lineage is cut: a lost executor re-reads files instead of recomputing upstream stages.
    """
    root = ensure_checkpoint_dir(df.sparkSession)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
