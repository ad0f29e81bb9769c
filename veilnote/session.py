"""Session helpers: lineage cuts, scratch folders, size-checked broadcasts."""
from __future__ import annotations

import tempfile
import threading
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024


def build_session(app: str = "veilnote", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs rely on; the cluster sets the rest."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDER:
        _OWN_FOLDER[app] = tempfile.mkdtemp(prefix="veilnote-")
    return _OWN_FOLDER[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Staging:
    """Intermediate tables of a run: Parquet in a folder of its own, removed at the end, also after a failure.

    While it is open, ``cut_lineage`` in the same thread puts its tables there.
    """
    _open = threading.local()

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path = spark, scratch_path(spark, "staging")

    def __enter__(self) -> Staging:
        self._open.stack = [*self.current(), self]
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        self._open.stack = self.current()[:-1]
        remove(self.spark, self.path)

    @classmethod
    def current(cls) -> list[Staging]:
        return getattr(cls._open, "stack", [])

    def put(self, df: DataFrame) -> DataFrame:
        return written(df, f"{self.path}/{uuid.uuid4().hex}")


def written(df: DataFrame, path: str) -> DataFrame:
    """The table, written and read again: lineage is cut and later reads take only the columns that they need."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A table that is computed once and survives executor loss, in the shared folder: staged if a run's staging is
    open, so that it goes with the run."""
    if Staging.current():
        return Staging.current()[-1].put(df)
    return written(df, scratch_path(df.sparkSession, "cut"))


def fits_broadcast(rows: int, text_bytes: int = 0) -> bool:
    """Whether a measured side is small enough to be sent to every executor."""
    return rows <= BROADCAST_ROWS and text_bytes <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast hint only after the side was measured to be small.

    The rows measured stop at the bound, so a scan or a projection of one is
    measured cheaply; give the side before any distinct or aggregate where the
    join allows it.  A larger side is left to an ordinary shuffle join.
    """
    sizes = [F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns]
    seen = df.limit(BROADCAST_ROWS + 1).select(sum(sizes, F.lit(0)).alias("n")).agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return F.broadcast(df) if fits_broadcast(*seen) else df


def folder_of(spark: SparkSession, path: str):
    """File system of a path and the path, for metadata operations (rename, delete)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = folder_of(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    system, target = folder_of(spark, path)
    system.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; a failed rename is an error."""
    system, old = folder_of(spark, source)
    new = folder_of(spark, target)[1]
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


_FEW_SPLITS: dict[tuple, bool] = {}


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet; a scan with fewer splits than cores is spread over them.

    Text work is heavy per row, and a single small file would be one task.
    Larger scans stay as they are.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    known = (path, spark.sparkContext.applicationId)
    if known not in _FEW_SPLITS:
        _FEW_SPLITS[known] = df.rdd.getNumPartitions() < cores
    return df.repartition(cores) if _FEW_SPLITS[known] else df
