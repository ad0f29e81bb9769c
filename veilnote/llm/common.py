"""Shared folder, written tables and Arrow batches for the operators of this subpackage."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows of an Arrow batch that carries whole texts, so that a batch stays small.
TEXT_ROWS = 500


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Unset on a local master (tests): a new temporary one, kept for the
    session. Unset elsewhere: an error, as executors don't share a machine-local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet to the shared folder and read again: lineage is cut, columns can be pruned,
    and lost executors cost nothing."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


class Scratch:
    """Tables of one run by name, removed once nothing reads them any more, so that they don't add up on the disk."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, frame: DataFrame, name: str) -> DataFrame:
        """As `written`. An earlier table of the name, which the frame may read, is removed afterwards."""
        path = new_path(self.spark, name)
        frame.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                remove(self.spark, self.paths.pop(name))


def map_batches(frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """mapInArrow, batch by batch, with batches of few rows since texts may be long."""
    spark = frame.sparkSession
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := function(batch)) is not None:
                yield made

    return frame.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that `written` made, once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
