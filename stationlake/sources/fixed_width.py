"""Fixed-width month records: one line per station, month and element, 31 day slots.

Layout (1-based columns): id 1-11, year 12-15, month 16-17, element 18-21, then
for day d a 5-character value at 22 + 8(d-1) followed by the m, q and s flags.
Parsing is native column work: ``substring`` for the header, ``transform`` over
the month's valid days for the slots, ``inline`` to rows. No UDF, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators.conform import ELEMENT_CODES
from stationlake.schema import MISSING
from stationlake.sources.header_csv import line_place

SLOT_WIDTH = 8
FIRST_SLOT = 22  # 1-based column of day 1's value


def parse_dly_lines(lines: DataFrame, elements: Sequence[str] = ELEMENT_CODES, line_col: str = "value",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Lines -> (station_id, obs_date, element, value_raw, mflag, qflag, sflag).

    Only slots 1 .. days-in-month become dates (a value beyond the month end
    is ignored, and ``make_date`` never sees Feb 30). Blank and -9999 values
    produce no row; blank flags become NULL; a line cut short yields blank
    slots. The element allow-list is applied before the slots are expanded.
    """
    ln = F.col(line_col)
    head = lines.select(
        *keep,
        ln.alias("_line"),
        F.substring(ln, 1, 11).alias("station_id"),
        F.substring(ln, 12, 4).cast("int").alias("_year"),
        F.substring(ln, 16, 2).cast("int").alias("_month"),
        F.substring(ln, 18, 4).alias("element"),
    ).where(F.col("element").isin(list(elements)))
    slots = F.expr(f"""
      transform(sequence(1, day(last_day(make_date(_year, _month, 1)))), d -> named_struct(
        'day', d,
        'v', trim(substring(_line, {FIRST_SLOT} + (d - 1) * {SLOT_WIDTH}, 5)),
        'm', nullif(trim(substring(_line, {FIRST_SLOT + 5} + (d - 1) * {SLOT_WIDTH}, 1)), ''),
        'q', nullif(trim(substring(_line, {FIRST_SLOT + 6} + (d - 1) * {SLOT_WIDTH}, 1)), ''),
        's', nullif(trim(substring(_line, {FIRST_SLOT + 7} + (d - 1) * {SLOT_WIDTH}, 1)), '')))""")
    rows = head.select(*keep, "station_id", "_year", "_month", "element", F.inline(slots))
    rows = rows.where((F.col("v") != "") & (F.col("v") != str(MISSING)))
    return rows.select(
        *keep, "station_id",
        F.make_date("_year", "_month", "day").alias("obs_date"),
        "element",
        F.col("v").cast("int").alias("value_raw"),
        F.col("m").alias("mflag"), F.col("q").alias("qflag"), F.col("s").alias("sflag"),
    )


def read_dly(spark: SparkSession, path: str, elements: Sequence[str] = ELEMENT_CODES,
             glob: str = "*.dly") -> DataFrame:
    """Read month-record files (``glob``) under ``path``; ``file_name`` and ``line_id`` record arrival order."""
    lines = (spark.read.option("pathGlobFilter", glob).text(path)
             .select("value", F.col("_metadata.file_name").alias("file_name"), line_place().alias("line_id")))
    return parse_dly_lines(lines, elements, keep=("file_name", "line_id"))
