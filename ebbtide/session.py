"""Session helpers: a default session and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}  # applications whose workers have the package
_LOCAL_ROOTS: dict[str, str] = {}  # scratch roots of local sessions that name none


def local_session(app: str = "ebbtide", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of the session's application, once.

    The archive is sent by Spark's own file server; workers import from it wherever they run.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(home)))
    folder = tempfile.TemporaryDirectory(prefix="ebbtide-code-")  # the driver serves the file as long as it lives
    path = os.path.join(folder.name, "ebbtide.zip")
    with open(path, "wb") as file:
        file.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED[app] = folder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder; a cluster that names no shared
    folder is refused, because executors could not read each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="ebbtide-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the scratch root, never reused."""
    return f"{scratch_root(spark)}/ebbtide/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage, survives lost executors and keeps later passes column-pruned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`written`, and the number of rows from the written footers. An observation would count them during the write, but
    after one Spark 4.1 can no longer ship logistic models to its tasks (see :func:`ebbtide.sources.tables.load_table`)."""
    table = written(df, name)
    return table, table.count()


def release_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote below the scratch root; frames that still read it fail."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/ebbtide/{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
