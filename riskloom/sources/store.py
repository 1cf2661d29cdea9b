"""Written frames: the shared folder, materialised intermediates, and table / file sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Paths handed out inside the innermost open ``scratch_scope``; None outside of any.
_written: ContextVar[list[str] | None] = ContextVar("riskloom_scratch", default=None)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A local session without that
    setting uses a folder in its warehouse; on a cluster the missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_riskloom_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    if (held := _written.get()) is not None:
        held.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving whatever the library wrote below the shared folder inside the block.

    Results built inside must be written or collected before the block ends.
    """
    token = _written.set([])
    try:
        yield
    finally:
        for path in _written.get() or []:
            remove_path(spark, path)
        _written.reset(token)


def materialise(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write a frame once and read it back: cuts the lineage and survives lost executors.

    Used where several passes need the same derived rows. The written form is
    columnar, so each later pass reads only its own columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, name: str = "frame") -> tuple[DataFrame, int]:
    """``materialise``, and the number of rows as the write itself counted them."""
    counted = Observation()
    stored = materialise(df.observe(counted, F.count(F.lit(1)).alias("rows")), name)
    return stored, counted.get["rows"]


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_skip_bad(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """CSV as text columns, without the lines that have too many fields; short lines are padded with NULL.

    The reader keeps the text of lines whose field count is wrong. Such a line is
    parsed again with a mark behind it: if the mark is not among the first fields,
    the line was too long, be it by an empty field.
    """
    raw, mark = "_raw", "\u0001"
    schema = StructType()
    for c in [*columns, raw]:
        schema = schema.add(c, "string")
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", raw)
        .option("columnPruning", False)
        .csv(path)
    )
    names = [f"f{i}" for i in range(len(columns) + 1)]
    fields = F.from_csv(F.concat(F.col(raw), F.lit(f",{mark}")), ", ".join(f"{n} string" for n in names))
    ends = F.exists(F.array(*[fields.getField(n) for n in names]), lambda f: f.eqNullSafe(F.lit(mark)))
    return df.where(F.col(raw).isNull() | ends).select(*columns)


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_results(df: DataFrame, path: str) -> None:
    """Add rows to a result table, creating it when absent."""
    df.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "overwrite") -> None:
    """Replace or extend a database table; each partition writes over its own connection."""
    df.write.jdbc(url, table, mode=mode, properties=properties)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], key: str, low: int, high: int, partitions: int
) -> DataFrame:
    """Database table read in parallel key ranges."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions, properties=properties
    )


def read_json_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One record per JSON document, documents may span lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system of the path."""
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder the library wrote; an absent one is no error."""
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target, fs = hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole, replacing what was there: readers never see a part of it."""
    target, fs = hadoop_path(spark, path)
    aside, _ = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(target, False)
    fs.rename(aside, target)


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it belongs to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
