"""Session settings and the shared folder for stage tables."""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_STAGES: dict[tuple[str, str], str] = {}
_LOCAL_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cpus: int = 8, name: str = "docpipe") -> SparkSession:
    """Session for tests and measurements on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        # small inputs: keep one partition per core instead of merging all into one
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="docpipe-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the functions that run
    there in Python. Not needed where it is installed on every node."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root, name = os.path.split(package)
    target = os.path.join(tempfile.mkdtemp(prefix="docpipe-package-"), name)
    context.addPyFile(shutil.make_archive(target, "zip", root, name))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="docpipe-stages-")
    return _LOCAL_ROOTS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, below the shared folder; not yet made."""
    return f"{shared_folder(spark).rstrip('/')}/docpipe/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder of any store that Spark can reach; nothing if it is not there."""
    files, hadoop = _file_system(spark, path)
    return [s.getPath().toString() for s in files.listStatus(hadoop)] if files.exists(hadoop) else []


@contextmanager
def whole_variants(spark: SparkSession):
    """VARIANT columns are written in one piece while this lasts. By default their paths become
    columns of the file, of which a reader of whole records has to build every record anew."""
    name = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def delete_path(spark: SparkSession, path: str) -> None:
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def stage(spark: SparkSession, source: str, name: str, build, whole: bool = False) -> DataFrame:
    """Write ``build()`` once per application and ``source``, then read it back.

    The written table cuts the lineage: a lost executor costs the re-reading of some files,
    not the work that led to them. ``source`` is expected not to change while the
    application runs. ``whole`` is for tables whose VARIANT columns are read whole, see
    :func:`whole_variants`.
    """
    key = hashlib.sha256(f"{source}\n{name}".encode()).hexdigest()[:16]
    app = spark.sparkContext.applicationId
    if (app, key) not in _STAGES:
        path = f"{shared_folder(spark).rstrip('/')}/docpipe/{app}/{name}-{key}"
        with whole_variants(spark) if whole else nullcontext():
            build().write.mode("overwrite").parquet(path)
        _STAGES[app, key] = path
    return spark.read.parquet(_STAGES[app, key])
