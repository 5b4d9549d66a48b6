"""Helpers shared by the operators: Arrow batches of texts, written tables, seeded hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.session import drop_tables, table_path

#: A word is a maximal run of anything but ASCII white space (fixed by the contracts).
WORD_REGEX = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch: long texts make large batches otherwise.
BATCH_ROWS = 1000
#: A table is broadcast up to this many measured bytes; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage at a
    table that survives the loss of an executor."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, and where the table is, for ``released``."""
    path = table_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def released(spark: SparkSession, *paths: str) -> None:
    """Delete tables of ``stored_at`` that nothing reads any more (left to ``drop_tables`` where the session can't delete files)."""
    if hasattr(spark, "_jvm"):
        drop_tables(spark, list(paths))


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker: at most ``BATCH_ROWS`` texts at a time.

    The session keeps the setting, as results are computed later; a smaller one of the caller's stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; null is the empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def add_columns(df: DataFrame, text: str, fields: list[tuple[str, str]],
                fn: Callable[[list[bytes]], list[list]]) -> DataFrame:
    """``df`` with ``fields`` (name, Spark type) appended; ``fn`` maps the batch's
    texts to one list for each field. An input column of such a name is replaced."""
    small_batches(df.sparkSession)
    new = {n for n, _ in fields}
    kept = [f for f in df.schema.fields if f.name not in new or f.name == text]
    if text in new:
        raise ValueError(f"{text} is the input column")
    df = df.select(*[F.col(f"`{f.name}`") for f in kept])
    added = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    at = [f.name for f in kept].index(text)
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [(f.name, to_arrow_type(f.dataType)) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = fn(text_bytes(b.column(at)))
            arrays = [pa.array(c, type=t) for c, (_, t) in zip(cols, arrow)]
            yield pa.RecordBatch.from_arrays(b.columns + arrays, names=b.schema.names + [n for n, _ in arrow])

    return df.mapInArrow(run, T.StructType(kept + added.fields))


def measured_bytes(df: DataFrame) -> int:
    """Rows times eight bytes a column, plus the real length of strings and binaries, and of nested values as JSON."""
    size = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        size = size + 8
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return int(df.agg(F.sum(size).alias("b")).first()["b"] or 0)


def hinted(small: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``small`` (a written table) with a broadcast hint if its measured size is
    within ``limit``; else as it is, for a shuffled join with the same result."""
    return F.broadcast(small) if measured_bytes(small) <= limit else small


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, drop: list[str] = ()) -> DataFrame:
    """``df`` (without ``drop``) and nth, from 0: the place of each row among those of its ``group``, in ascending ``order``
    (null first; equal rows in any order).

    No window holds a group: the rows are range partitioned and sorted, so that a large group spans several
    partitions, and written; a row's place is its place in its partition's stretch of the group plus the counts of
    the stretches before. What is grouped by one key is one row a partition.
    """
    dealt = (df.withColumn("_tie", F.monotonically_increasing_id())
             .repartitionByRange(*group, *order, "_tie").sortWithinPartitions(*group, *order, "_tie")
             .withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()))
    rows = stored(dealt.drop("_tie", *drop), name)
    stretches = rows.groupBy(*group, "_part").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_p"), "_first",
                              F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    same = rows["_part"] == starts["_p"]
    for g in group:
        same = same & rows[g].eqNullSafe(starts[f"_{g}"])
    return (rows.join(starts, same).withColumn("nth", F.col("_before") + F.col("_seq") - F.col("_first"))
            .drop("_part", "_p", "_seq", "_first", "_before", *[f"_{g}" for g in group]))
