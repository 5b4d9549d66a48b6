"""Raw formats: fixed-width month records, by-station CSV, reanalysis JSON."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from stationlake.plans.landing import render_dly_lines
from stationlake.sources.fixed_width import parse_dly_lines
from stationlake.sources.reanalysis_json import explode_daily_arrays
from stationlake.sources.station_csv import parse_station_csv


def line(sid, year, month, element, slots):
    """Build one 269-character record; ``slots`` maps day -> (value, m, q, s)."""
    body = ""
    for d in range(1, 32):
        v, m, q, s = slots.get(d, (-9999, " ", " ", " "))
        body += f"{v:5d}{m}{q}{s}"
    return f"{sid:<11}{year:04d}{month:02d}{element:<4}{body}"


def parse(spark, lines, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return {(r.station_id, r.obs_date, r.element): r for r in parse_dly_lines(df, **kw).collect()}


def test_february_slots_beyond_month_end_ignored(spark):
    non_leap = line("AB000000001", 1999, 2, "TMAX", {28: (10, " ", " ", " "), 29: (11, " ", " ", " "),
                                                    30: (12, " ", " ", " "), 31: (13, " ", " ", " ")})
    leap = line("AB000000001", 2000, 2, "TMAX", {29: (21, " ", " ", " "), 30: (22, " ", " ", " ")})
    rows = parse(spark, [non_leap, leap])
    assert set(k[1] for k in rows) == {dt.date(1999, 2, 28), dt.date(2000, 2, 29)}
    assert rows[("AB000000001", dt.date(2000, 2, 29), "TMAX")].value_raw == 21


def test_missing_blank_negative_flags_and_short_line(spark):
    slots = {1: (-9999, "X", "X", "X"), 2: (-52, " ", " ", " "), 3: (7, "T", "I", "E"), 4: (0, " ", "O", " ")}
    full = line("AB000000002", 2001, 1, "PRCP", slots)
    blank_value = full[:21 + 8 * 4] + "     " + "   " + full[21 + 8 * 5:]
    short = full[: 21 + 8 * 3 - 1]  # cut inside day 3's flags: day 3 keeps value, flags partly missing
    rows = parse(spark, [blank_value])
    assert (("AB000000002", dt.date(2001, 1, 1), "PRCP") not in rows)
    r2 = rows[("AB000000002", dt.date(2001, 1, 2), "PRCP")]
    assert r2.value_raw == -52 and r2.mflag is None and r2.qflag is None and r2.sflag is None
    r3 = rows[("AB000000002", dt.date(2001, 1, 3), "PRCP")]
    assert (r3.mflag, r3.qflag, r3.sflag) == ("T", "I", "E")
    assert rows[("AB000000002", dt.date(2001, 1, 4), "PRCP")].qflag == "O"
    assert len(rows) == 3  # day 5 blank, days 6.. missing
    short_rows = parse(spark, [short])
    assert set(k[1].day for k in short_rows) == {2, 3}
    assert short_rows[("AB000000002", dt.date(2001, 1, 3), "PRCP")].sflag is None


def test_element_outside_allow_list(spark):
    rows = parse(spark, [line("AB000000003", 2001, 1, "WT01", {1: (1, " ", " ", " ")}),
                         line("AB000000003", 2001, 1, "TMIN", {1: (-5, " ", " ", " ")})])
    assert [k[2] for k in rows] == ["TMIN"]


def test_render_parse_round_trip(spark):
    src = spark.createDataFrame(
        [("AB000000004", dt.date(2004, 2, 29), "TMAX", 123, None, "X", "S"),
         ("AB000000004", dt.date(2004, 3, 1), "TMAX", -7, "B", None, None)],
        "station_id string, obs_date date, element string, value_raw int, mflag string, qflag string, sflag string")
    back = parse_dly_lines(render_dly_lines(src))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))


def test_value_wider_than_its_field_fails(spark):
    src = spark.createDataFrame([("AB000000004", dt.date(2004, 2, 29), "TMAX", 123456, None, None, None)],
                                "station_id string, obs_date date, element string, value_raw int, mflag string, "
                                "qflag string, sflag string")
    with pytest.raises(Exception, match="wider than 5"):
        render_dly_lines(src).collect()


def test_station_csv_parse(spark):
    raw = spark.createDataFrame(
        [("AB000000005", "20010102", "TMAX", "105", "", " ", "E", "0700"),
         ("AB000000005", "20010103", "TMAX", "-9999", "", "", "", ""),
         ("AB000000005", "20010104", "WT03", "1", "", "", "", ""),
         ("AB000000005", "20010105", "PRCP", "3", "T", "X", "", "")],
        "ID string, DATE string, ELEMENT string, DATA_VALUE string, M_FLAG string, Q_FLAG string, S_FLAG string, "
        "OBS_TIME string")
    rows = {r.obs_date.day: r for r in parse_station_csv(raw).collect()}
    assert set(rows) == {2, 5}
    assert rows[2].value_raw == 105 and rows[2].qflag is None and rows[2].sflag == "E"
    assert (rows[5].mflag, rows[5].qflag) == ("T", "X")


def test_reanalysis_parallel_arrays(spark):
    from stationlake.schema import REANALYSIS_JSON

    body = ('{"daily": {"time": ["2020-01-01", "2020-01-02"], "temperature_2m_max": [1.5, 2.5], '
            '"precipitation_sum": [0.0, null]}}')
    df = spark.createDataFrame([("AB000000006", body)], "station_id string, body string")
    parsed = df.select("station_id", F.from_json("body", REANALYSIS_JSON).alias("j")).select("station_id", "j.daily")
    rows = explode_daily_arrays(parsed).orderBy("obs_date").collect()
    assert [r.obs_date for r in rows] == [dt.date(2020, 1, 1), dt.date(2020, 1, 2)]
    assert [r.temperature_2m_max for r in rows] == [1.5, 2.5]
    assert rows[1].precipitation_sum is None and rows[0].temperature_2m_min is None
