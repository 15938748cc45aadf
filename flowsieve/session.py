"""Session settings and the two ways intermediate results are kept.

`materialize` writes a table into the folder that ``spark.checkpoint.dir`` names, so lost executors
never force a replay of the steps before it. `bounded_table` / `attach_table` implement the only
broadcast rule of the package: a side is broadcast after its row count was checked, and joined by shuffle
otherwise.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def build_session(app: str = "flowsieve", cores: str = "*", **conf: str) -> SparkSession:
    """Session for local runs; on a cluster pass your own session to the operators."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compile_small_methods(spark: SparkSession) -> None:
    """Generate code per operator where a whole stage would be a method beyond 8,000 bytecodes, which HotSpot only interprets.

    Ten models' expressions over one row are such a stage.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, as ``--py-files`` does; once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="flowsieve-src-")) / "flowsieve.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets one temporary folder per application and a cluster gets an error.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="flowsieve-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and fixes the row layout."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialize` wrote and nothing will read again; other tables stay."""
    for table in tables:
        path = table.__dict__.pop("_written_to", None)
        if path:
            jvm = table.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def bounded_table(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Evaluate a table expected to be small once: a local table of at most ``limit`` rows, a written one beyond."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return materialize(df, "side")
    return df.sparkSession.createDataFrame(rows, df.schema)


def attach_table(df: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a `bounded_table` result: local tables are broadcast, written ones joined by shuffle.

    Keys match null-safely, so a group without a name is a group like any other.
    """
    renamed = side.withColumnsRenamed({c: f"_side_{c}" for c in on})
    local = not side.inputFiles()
    same = [F.col(c).eqNullSafe(F.col(f"_side_{c}")) for c in on]
    return df.join(F.broadcast(renamed) if local else renamed, same, how).drop(*[f"_side_{c}" for c in on])


def attach(df: DataFrame, side: DataFrame, on: list[str], how: str = "left",
           limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``side`` after its size was checked: broadcast when small, a shuffle join beyond."""
    return attach_table(df, bounded_table(side, limit), on, how)
