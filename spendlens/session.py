"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "spendlens", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators rely on (AQE, UTC, ANSI as shipped)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets its own folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_scratch[app] = tempfile.mkdtemp(prefix="spendlens-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, fixes values that Spark could
    otherwise compute twice (sort positions), and leaves a prunable table of known size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove the files of tables that ``materialize`` stored and that nothing will read again."""
    for table in tables:
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once for each application, for steps that run Python there."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="spendlens-")) / "spendlens.zip"  # the driver serves it to executors
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, Path("spendlens") / file.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
