"""Writers of the landed raw formats, used by the registered queries and the tests to make input files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.schema import MISSING, REANALYSIS_VARS


def render_station_csv(long: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long rows -> the all-text CSV columns (the writer side, used to land test files)."""
    return long.select(
        *keep,
        F.col("station_id").alias("ID"), F.date_format("obs_date", "yyyyMMdd").alias("DATE"),
        F.col("element").alias("ELEMENT"), F.col("value_raw").cast("string").alias("DATA_VALUE"),
        F.coalesce("mflag", F.lit("")).alias("M_FLAG"), F.coalesce("qflag", F.lit("")).alias("Q_FLAG"),
        F.coalesce("sflag", F.lit("")).alias("S_FLAG"), F.lit("0700").alias("OBS_TIME"),
    )


def render_dly_lines(long: DataFrame) -> DataFrame:
    """Long rows (station_id, obs_date, element, value_raw, mflag, qflag, sflag) -> month records.

    The writer side of the format (used to land test archives). One group per
    station-month-element holds at most 31 slots; a value wider than its five
    characters fails; days without a row are
    written as -9999 with blank flags.
    """
    text = F.format_string("%5d", F.col("value_raw"))
    wide = F.raise_error(F.concat(F.lit("value wider than 5 characters: "), text)).cast("string")
    slot = F.concat(F.when(F.length(text) <= 5, text).otherwise(wide), F.coalesce("mflag", F.lit(" ")),
                           F.coalesce("qflag", F.lit(" ")), F.coalesce("sflag", F.lit(" ")))
    g = long.groupBy("station_id", F.year("obs_date").alias("y"), F.month("obs_date").alias("m"), "element").agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("obs_date"), slot))).alias("slots"))
    body = F.expr(f"concat_ws('', transform(sequence(1, 31), d -> coalesce(element_at(slots, d), '{MISSING}   ')))")
    return g.select(F.concat(F.rpad("station_id", 11, " "), F.lpad(F.col("y").cast("string"), 4, "0"),
                             F.lpad(F.col("m").cast("string"), 2, "0"), F.rpad("element", 4, " "), body).alias("value"))


def pack_daily_arrays(daily: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Writer side: curated rows -> one response per station-year, ``daily`` as parallel arrays.

    ``mapping`` maps response variables to columns of ``daily``. One group is
    a station-year, at most 366 entries, so a packed row is bounded.
    """
    cols = list(mapping.values())
    g = daily.groupBy("station_id", F.year("obs_date").alias("_y")).agg(
        F.sort_array(F.collect_list(F.struct("obs_date", *cols))).alias("_rows"))
    fields = [F.transform("_rows", lambda r: F.date_format(r["obs_date"], "yyyy-MM-dd")).alias("time")]
    def field_of(c: str):
        return lambda r: r[c].cast("double")

    for var in REANALYSIS_VARS:
        if var in mapping:
            fields.append(F.transform("_rows", field_of(mapping[var])).alias(var))
        else:
            fields.append(F.lit(None).cast("array<double>").alias(var))
    fields += [F.lit(None).cast("array<string>").alias("sunrise"), F.lit(None).cast("array<string>").alias("sunset")]
    return g.select("station_id", F.struct(*fields).alias("daily"))


def land_named(spark: SparkSession, df: DataFrame, stem: str, path: str, fmt: str, suffix: str, **options) -> None:
    """Write one file ``<stem value><suffix>`` into the folder ``path`` for each value of column ``stem``.

    Spark writes one part file a value; the files are then renamed through the
    Hadoop file system of ``path``.
    """
    parts = f"{path}-parts{suffix}"
    df.repartition(stem).write.mode("overwrite").options(**options).partitionBy(stem).format(fmt).save(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(parts)
    fs = root.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    for folder in fs.listStatus(root):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(f"{stem}="):
            files = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            for i, f in enumerate(files):
                value = name.split("=", 1)[1]
                target = f"{path}/{value}{f'-{i}' if i else ''}{suffix}"
                fs.rename(f, jvm.org.apache.hadoop.fs.Path(target))
