"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def build_session(app: str = "orebelt", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder of its
    own. On a cluster a machine-local folder would be invisible to the other executors, so a
    missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="orebelt-")
    return _local_roots[app]


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored copy.

    For a result that is read more than once: it is computed a single time, and lost executors
    cost a re-read instead of the whole upstream plan.
    """
    spark = df.sparkSession
    path = new_scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; nothing below it is listed."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Paths of the entries directly in ``path``."""
    files, place = _file_system(spark, path)
    return [str(entry.getPath()) for entry in files.listStatus(place)]


def delete_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def literal_rows(
    spark: SparkSession, rows: Sequence[Sequence], columns: Mapping[str, str]
) -> DataFrame:
    """A few driver-side values as a frame of constants, e.g. ``{"run": "int"}`` for the columns.

    Unlike ``createDataFrame`` it starts no Python worker.
    """
    structs = [
        F.struct(
            *[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, columns.items())]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
