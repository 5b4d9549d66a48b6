"""CSV files whose columns are found by header name, whatever their order, case or padding.

A file's header is its first line that isn't blank: by position, never by its looks. The
headers come from a job of their own that reads the head of each file only; the data
are read once, by a scan that skips that line.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators.joins import join_dim
from stationlake.session import table_path

#: Lines that a header task takes from the reader at a time; it stops at the first that isn't blank.
HEAD_LINES = 16


def line_place() -> Column:
    """A line's place in its file: where its split begins, then its order in the split.

    Rows of one split are numbered by the task that reads it; splits are ordered by their first byte, however
    they are dealt out to tasks.
    """
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def first_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """file_path, file_name, header: the first line that isn't blank of every file with one, as a written table.

    A session of its own deals out one split a task, and each task leaves its split after the first lines; so what is
    read doesn't grow with the files' length. The caller's session settings stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HEAD_LINES))
    reader = own.read.option("pathGlobFilter", glob) if glob else own.read
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                                     F.col("_metadata.file_block_start").alias("block"), "value")

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and b.column(2)[0].as_py() > 0:
                return  # not the file's first split
            for i, line in enumerate(b.column(3).to_pylist()):
                if line and line.strip(" \t\r﻿"):
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), b.column(3).slice(i, 1)],
                                                     names=["file_path", "file_name", "header"])
                    return

    place = table_path(spark, "csv-headers")
    found = lines.mapInArrow(head, "file_path string, file_name string, header string")
    found.write.parquet(place)
    return spark.read.schema(found.schema).parquet(place)


def read_by_header(spark: SparkSession, path: str | list[str], names: Sequence[str], required: Sequence[str],
                   glob: str | None = None, null_value: str = "", only: DataFrame | None = None) -> DataFrame:
    """``names`` as text columns, ``file_name`` and ``line_id``, from every CSV file under ``path``.

    The driver sees each distinct header once. Files with one header need no join; with several, a row's columns are
    placed by its file's header. A header without a ``required`` column fails the job; other absent columns are NULL,
    unknown ones are ignored. ``only`` (one column, file_name) leaves all other files out. ``line_id`` orders the
    lines of a file.
    """
    def wanted(df: DataFrame) -> DataFrame:
        return df if only is None else join_dim(df, only, "file_name", how="left_semi")

    first = wanted(first_lines(spark, path, glob))
    headers = sorted(r["header"] for r in first.select("header").distinct().collect())
    places = {}
    for h in headers:
        found = [c.strip().strip('"').strip("﻿ \r").upper() for c in h.split(",")]
        missing = [n for n in required if n.upper() not in found]
        if missing:
            raise ValueError(f"CSV header {h!r} under {path} lacks {', '.join(missing)}")
        places[h] = [found.index(n.upper()) + 1 if n.upper() in found else 0 for n in names]
    width = max([len(h.split(",")) for h in headers], default=len(names))
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    raw = (reader.option("nullValue", null_value).option("header", True).option("enforceSchema", True)
           .csv(path, schema=", ".join(f"c{i} string" for i in range(width)))
           .select(*[f"c{i}" for i in range(width)], F.col("_metadata.file_path").alias("file_path"),
                   F.col("_metadata.file_name").alias("file_name"), line_place().alias("line_id")))
    rows = wanted(raw)
    if len(places) <= 1:
        at = next(iter(places.values()), [0] * len(names))
        cols = [F.col(f"c{p - 1}") if p else F.lit(None).cast("string") for p in at]
        return rows.select(*[c.alias(n) for c, n in zip(cols, names)], "file_name", "line_id")
    known = F.create_map(*[x for h, at in places.items() for x in (F.lit(h), F.array(*[F.lit(p) for p in at]))])
    rows = join_dim(rows, first.select("file_path", known[F.col("header")].alias("at")), "file_path")
    cells = F.array(*[F.col(f"c{i}") for i in range(width)])
    return rows.select(*[F.get(cells, F.nullif(F.col("at")[i], F.lit(0)) - 1).alias(n) for i, n in enumerate(names)],
                       "file_name", "line_id")
