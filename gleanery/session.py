"""What the library needs from a session: its code on the workers and a scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key tables up to this measured size are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows go to Python in batches of about so many bytes, unless the session says otherwise: a task holds a few of them at a time.
ARROW_BATCH = "8m"

# Folders of shards are listed in so many tasks a core, unless the session says otherwise; Spark's own choice is a task per folder.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 4

# Shuffle files of a query go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_prepared: set[str] = set()
_local_scratch: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _prepared:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="gleanery-"), "gleanery"),
            "zip",
            root_dir=os.path.dirname(package),
            base_dir=os.path.basename(package),
        )
        spark.sparkContext.addPyFile(archive)
        _prepared.add(app)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    if spark.conf.get(LISTING, None) is None:
        spark.conf.set(LISTING, str(LISTING_TASKS * spark.sparkContext.defaultParallelism))
    # Repeated keys in a JSON object: the last one wins, instead of an error.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder that the session names."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="gleanery-scratch-"))
        base = _local_scratch[0]
    return f"{base.rstrip('/')}/gleanery/{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str, compression: str | None = None) -> None:
    """``df`` as Parquet; its shuffle files are removed after it, whatever holds for the session's other queries."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path, compression=compression)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to scratch storage and read it back, which ends its lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/table"
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one computation in the shared folder; they are removed when it ends.

    What outlives it has to be written elsewhere first, see ``stored``.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[tuple[str, DataFrame | None]] = []

    def store(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        """``df`` written and read back, until the computation ends."""
        path = scratch_dir(self._spark)
        self._paths.append((path, None))
        _write(df, f"{path}/table", compression)
        table = self._spark.read.schema(df.schema).parquet(f"{path}/table")
        self._paths[-1] = (path, table)
        return table

    def remove(self, table: DataFrame) -> None:
        """Take away a table that ``store`` gave and nothing reads any more."""
        for path in [p for p, t in self._paths if t is table]:
            self._delete(path)

    def _delete(self, path: str) -> None:
        context = self._spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path, _ in self._paths:
            self._delete(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], schema)


def row_bytes(df: DataFrame) -> Column:
    """Rough in-memory size of a row of a key table."""
    width = F.lit(48)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + F.coalesce(F.size(field.name), F.lit(0)) * 8
        else:
            width = width + F.lit(8)
    return width.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of a stored key table, from one aggregate over it."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()["bytes"]


def hint_if_small(df: DataFrame, size: int | None = None) -> DataFrame:
    """``broadcast(df)`` where the measured size allows it, else ``df`` for a shuffled join."""
    size = measured_bytes(df) if size is None else size
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
