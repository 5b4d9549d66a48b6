"""Sinks: staged tables, header-driven bulk load, load report, scoreboard upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators.quality import enforce
from stationlake.schema import Contract
from stationlake.sources import snapshots
from stationlake.sources.header_csv import read_by_header


def project(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select the contract columns in contract order, cast to the contract types.

    Strict mode fails the job on a value that doesn't fit its type, whatever the
    session's ANSI setting; audit mode makes it NULL, for the precision check to
    report. A NOT NULL column that is absent is an error in either mode.
    """
    absent = [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]
    if absent:
        raise ValueError(f"missing NOT NULL columns: {', '.join(absent)}")
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        cast = c.try_cast(f.dataType)
        if strict:
            said = F.concat(F.lit(f"{f.name}: value does not fit {f.dataType.simpleString()}: "), c.cast("string"))
            cast = F.when(c.isNotNull() & cast.isNull(), F.raise_error(said).cast(f.dataType)).otherwise(cast)
        cols.append(cast.alias(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                sort_within: Sequence[str] = (), range_by: Sequence[str] = ()) -> None:
    """Write a staged table.

    With ``partition_by`` the rows are first rebalanced on the partition
    columns (AQE splits oversized partitions and merges small ones), so each
    folder gets a few right-sized files. ``sort_within`` clusters rows inside
    each file for min/max skipping. ``range_by`` deals all rows out in ranges of
    these columns (sampled bounds, so a frequent leading value spans several
    files) and sorts by them: each file and row group then covers a narrow range,
    and a predicate on them skips the rest.
    """
    if range_by:
        if partition_by or sort_within:
            raise ValueError("range_by deals and sorts by itself")
        df = df.repartitionByRange(*range_by).sortWithinPartitions(*range_by)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("nullValue", "")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, bucket_col: str, buckets: int,
                   sort_by: Sequence[str] = ()) -> DataFrame:
    """Save ``df`` as an external table bucketed (hash-partitioned) on ``bucket_col`` at ``path``.

    Later windows and aggregates keyed on ``bucket_col`` read the buckets as
    their partitions and need no shuffle; ``sort_by`` orders rows inside each
    bucket file. Returns the table as a DataFrame.
    """
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, bucket_col)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "")
    return reader.load(path)


def bulk_load(spark: SparkSession, path: str | list[str], target: Contract | T.StructType, strict: bool = True,
              refs: dict[str, DataFrame] | None = None, check: bool = True) -> DataFrame:
    """Load staged CSV files: each file's own header names its columns, '' is NULL.

    Columns are matched by header name (any order, other ones ignored, absent
    ones NULL), contract defaults fill NULLs (``is_gsn`` -> 0), and values are
    cast to the target types. A strict load of a contract also fails the job on
    key, NOT NULL, length and (with ``refs``) reference violations; without
    ``check`` that is left to the caller (``snapshots.Load`` checks what it has
    written).
    """
    contract = target if isinstance(target, Contract) else None
    schema = contract.schema if contract else target
    defaults = contract.defaults if contract else {}
    required = [f.name for f in schema.fields if not f.nullable and f.name not in defaults]
    raw = read_by_header(spark, path, schema.fieldNames(), required or schema.fieldNames()[:1]).drop("file_name", "line_id")
    for c, v in defaults.items():
        raw = raw.withColumn(c, F.coalesce(F.col(c), F.lit(str(v))))
    out = project(raw, schema, strict)
    return enforce(out, contract, refs) if contract and strict and check else out


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per loaded table, one aggregate each, as (table_name, row_count)."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def score_upsert(old: DataFrame, new: DataFrame, key: Sequence[str] = ("station_id", "model")) -> DataFrame:
    """Replace or add scoreboard rows by key: ``old`` rows without a new counterpart, plus ``new``."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new)


def _ordering(order_by: Sequence[str]) -> list[Column]:
    """Columns to sort by; a name after ``-`` sorts descending."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order_by]


def update_scoreboard(spark: SparkSession, path: str, new: DataFrame, key: Sequence[str] = ("station_id", "model"),
                      order_by: Sequence[str] = ("-mae", "station_id", "model"), attempts: int = 5) -> DataFrame:
    """Replace or add the rows of ``new`` in the board stored at ``path`` and return it, largest MAE first.

    The board is a log of versions (``snapshots``): the new one is written in a
    folder of its own and published last, so a failed update leaves the old
    board. If another update publishes meanwhile, this one starts again from
    that board, ``attempts`` times at most.
    """
    for left in range(attempts - 1, -1, -1):
        try:
            with snapshots.Load(spark, path) as load:
                old = load.tables().get("scoreboard")
                board = new if old is None else score_upsert(old, new.select(*old.columns), key)
                load.write("scoreboard", board.orderBy(*_ordering(order_by)))
            break
        except snapshots.Conflict:
            if not left:
                raise
    return read_scoreboard(spark, path, load.version).orderBy(*_ordering(order_by))


def read_scoreboard(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The board stored at ``path`` (the latest, or ``version``); None where there is none yet."""
    return snapshots.read(spark, path, version).get("scoreboard")
