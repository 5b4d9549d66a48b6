"""Quality audits and data-contract checks.

The six audits read the audit and curated facts; the contract checks turn the
declared constraints (key, NOT NULL, references, precision, length) into
violation reports, since Spark tables do not enforce them on write.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.functions import days_between, decade, round_opt
from stationlake.operators.joins import join_dim
from stationlake.schema import OUTLIER_BOUNDS, Contract


def _names(stations: DataFrame) -> DataFrame:
    return stations.select("station_id", "station_name")


def qa_failures(obs: DataFrame) -> DataFrame:
    """Audit 1: failed records per quality flag."""
    return obs.where(F.col("qflag").isNotNull()).groupBy("qflag").agg(F.count(F.lit(1)).alias("failed_records"))


def impossible_days(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """Audit 2: station-days whose minimum exceeds their maximum."""
    bad = daily.where(F.col("tmin") > F.col("tmax")).select("station_id", "obs_date", "tmax", "tmin")
    return join_dim(bad, _names(stations), "station_id").select("station_name", "obs_date", "tmax", "tmin")


def decade_completeness(daily: DataFrame, stations: DataFrame, digits: int | None = 1) -> DataFrame:
    """Audit 3: days with tmax per station and decade, and percent of a 10-year span.

    Aggregated per (station_id, decade) first, then named: the join sees one
    row per station-decade instead of one per day.
    """
    per = daily.groupBy("station_id", decade(F.year("obs_date")).alias("decade")).agg(
        F.count("tmax").alias("days_with_tmax"))
    named = join_dim(per, _names(stations), "station_id")
    agg = named.groupBy("station_name", "decade").agg(F.sum("days_with_tmax").alias("days_with_tmax"))
    return agg.select("station_name", "decade", "days_with_tmax",
                      round_opt(F.col("days_with_tmax") * 100.0 / 3652.5, digits).alias("pct_complete"))


def gaps(daily: DataFrame) -> DataFrame:
    """Days since the previous observation of the same station (NULL on its first row)."""
    w = Window.partitionBy("station_id").orderBy("obs_date")
    return daily.select("station_id", "obs_date",
                        days_between("obs_date", F.lag("obs_date").over(w)).alias("days_since_prev"))


def gap_analysis(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """Audit 4: number of gaps (> 1 day) and the longest gap per station."""
    per = gaps(daily).groupBy("station_id").agg(
        F.count_if(F.col("days_since_prev") > 1).alias("gap_count"),
        F.max("days_since_prev").alias("longest_gap_days"),
    )
    return join_dim(per, _names(stations), "station_id").select(
        "station_id", "station_name", "gap_count", "longest_gap_days")


def outlier_scan(daily: DataFrame, stations: DataFrame,
                 bounds: Sequence[tuple[str, float | None, float | None]] = OUTLIER_BOUNDS) -> DataFrame:
    """Audit 5: values outside plausible bounds, one row per (station-day, metric).

    One scan: the metrics are unpivoted into an array, out-of-bound entries are
    kept by a per-metric predicate, and only those are exploded.
    """
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                        for m, _, _ in bounds])

    def out_of_bounds(x):
        cond = F.lit(False)
        for m, lo, hi in bounds:
            side = F.lit(False)
            if hi is not None:
                side = side | (x["value"] > F.lit(hi))
            if lo is not None:
                side = side | (x["value"] < F.lit(lo))
            cond = cond | ((x["metric"] == F.lit(m)) & side)
        return cond

    hits = daily.select("station_id", "obs_date", F.explode(F.filter(entries, out_of_bounds)).alias("e"))
    hits = hits.select("station_id", "obs_date", "e.metric", "e.value")
    return join_dim(hits, _names(stations), "station_id").select("station_name", "obs_date", "metric", "value")


def duplicate_grain(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Audit 6 / primary-key check: keys occurring more than once, with their count.

    A plain aggregate: partial counts are combined per task before the shuffle,
    so a key held by a third of all rows costs one partial row per task.
    """
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_violations(df: DataFrame, table_name: str, columns: Iterable[str]) -> DataFrame:
    """NULL count per NOT NULL column, one aggregate pass, unpivoted to rows."""
    cols = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "null_count")
    return long.select(F.lit(table_name).alias("table_name"), "column_name",
                       F.col("null_count").cast("bigint").alias("null_count"))


def fk_violations(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                  constraint_name: str) -> DataFrame:
    """Rows of ``child`` whose key has no parent, counted (anti join + one aggregate)."""
    parent_keys = parent.select(F.col(parent_col).alias(child_col))
    orphans = child.select(child_col).where(F.col(child_col).isNotNull()).join(parent_keys, child_col, "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(constraint_name).alias("constraint_name"), "violations")


def decimal_contract(df: DataFrame, precision: dict[str, tuple[int, int]],
                     max_length: dict[str, int] | None = None) -> DataFrame:
    """Values that do not fit their declared DECIMAL(p,s), and strings over their length.

    ``try_cast`` yields NULL on overflow; a NULL source is not a violation.
    """
    aggs, rules = [], []
    for c, (p, s) in precision.items():
        rule = f"decimal({p},{s})"
        aggs += [F.count(c).alias(f"{c}__n"),
                 F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS DECIMAL({p},{s}))").isNull())
                 .alias(f"{c}__bad")]
        rules.append((c, rule))
    for c, n in (max_length or {}).items():
        aggs += [F.count(c).alias(f"{c}__n"), F.count_if(F.length(c) > n).alias(f"{c}__bad")]
        rules.append((c, f"length<={n}"))
    row = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"),
                 F.col(f"{c}__n").cast("bigint").alias("n_checked"),
                 F.col(f"{c}__bad").cast("bigint").alias("violations"))
        for c, r in rules]))
    return row.select(stacked.alias("v")).select("v.*")


def _key_hash(*cols: Column) -> list[Column]:
    """128 bits that tell keys apart, nulls included."""
    marked = [x for c in cols for x in (c, c.isNull())]
    return [F.xxhash64(*marked).alias("h1"), F.xxhash64(F.lit(1), *marked).alias("h2")]


def contract_report(df: DataFrame, contract: Contract, refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """table_name, rule, column_name, violations: every rule of the contract on ``df``.

    Rules: ``key`` and ``unique`` (rows beyond the first of a key), ``not_null``,
    ``type`` (a value that the declared type can't hold), ``length``, and ``fk``
    for each reference whose parent is in ``refs``. One scan of ``df`` serves all
    of them: a row gives an entry (rule, key hash) for each key, unique and
    reference rule, and one for each row rule that it breaks; entries are counted
    map-side first, so a key that a third of all rows hold costs a row a task. The
    parents' keys, each marked with its rule, meet the counts in one join.
    """
    kind = {f.name: f.dataType for f in contract.schema.fields}
    col = lambda c: F.col(f"`{c}`")
    rows = [("not_null", c, col(c).isNull()) for c in contract.not_null if c in df.columns]
    rows += [("type", c, col(c).isNotNull() & col(c).try_cast(t).isNull()) for c, t in kind.items() if c in df.columns]
    rows += [("length", c, F.length(col(c)) > n) for c, n in contract.max_length.items() if c in df.columns]
    keys = [("key", contract.key), *[("unique", (c,)) for c in contract.unique]]
    links = [(c, parent, to) for c, (parent, to) in contract.references.items() if refs and parent in refs]
    names = [(r, c) for r, c, _ in rows] + [(r, ",".join(k)) for r, k in keys] + [("fk", c) for c, _, _ in links]

    zero = F.lit(0).cast("bigint")
    entry = lambda i, h: F.struct(F.lit(i).alias("i"), *h)
    entries = [F.when(bad, entry(i, [zero.alias("h1"), zero.alias("h2")])) for i, (_, _, bad) in enumerate(rows)]
    entries += [entry(len(rows) + i, _key_hash(*map(col, key))) for i, (_, key) in enumerate(keys)]
    first_link, parents = len(rows) + len(keys), None
    for i, (c, parent, to) in enumerate(links, first_link):
        as_parent = refs[parent].schema[to].dataType
        entries.append(F.when(col(c).isNotNull(), entry(i, _key_hash(col(c).try_cast(as_parent)))))
        there = refs[parent].where(col(to).isNotNull()).select(F.lit(i).alias("i"), *_key_hash(col(to)))
        parents = there if parents is None else parents.unionByName(there)
    counted = (df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
               .groupBy("i", "h1", "h2").agg(F.count(F.lit(1)).alias("n")))
    broken = F.when(F.col("i") < len(rows), F.col("n")).when(F.col("i") < first_link, F.col("n") - 1)
    if parents is not None:
        found = parents.distinct().withColumn("found", F.lit(True))
        counted = counted.join(found, ["i", "h1", "h2"], "left")
        broken = broken.when(F.col("found").isNull(), F.col("n"))
    sums = counted.groupBy("i").agg(F.sum(broken.otherwise(0)).cast("bigint").alias("violations"))
    listed = df.sparkSession.createDataFrame([(i, contract.name, r, c) for i, (r, c) in enumerate(names)],
                                             "i int, table_name string, rule string, column_name string")
    return listed.join(sums, "i", "left").select("table_name", "rule", "column_name",
                                                 F.coalesce("violations", zero).alias("violations"))


class ContractError(ValueError):
    """A strict load met rows that break the table's contract."""


def enforce(df: DataFrame, contract: Contract, refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` if it keeps every rule of ``contract``; else ContractError with the counts (a job runs here)."""
    bad = contract_report(df, contract, refs).where("violations > 0").collect()
    if bad:
        raise ContractError("; ".join(f"{r['table_name']}: {r['violations']} rows break {r['rule']}({r['column_name']})"
                                      for r in bad))
    return df


def model_ready(daily: DataFrame, start: str = "1960-01-01", coverage_start: str = "1990-01-01",
                coverage_end: str = "2018-03-01", coverage: float = 0.95) -> DataFrame:
    """Curated rows from ``start`` on, for stations whose tmax coverage since
    ``coverage_start`` reaches ``coverage`` of the days up to ``coverage_end``.

    The coverage is a pruned aggregate (partial counts are exchanged) and the
    rows are kept by a semi join on the few qualifying stations, so the fact
    itself is not shuffled.
    """
    cs = F.to_date(F.lit(coverage_start))
    span = F.datediff(F.to_date(F.lit(coverage_end)), cs)
    covered = daily.where(F.col("obs_date") >= cs).groupBy("station_id").agg(F.count("tmax").alias("n"))
    ready = covered.where(F.col("n") >= F.lit(coverage) * span).select("station_id")
    return join_dim(daily.where(F.col("obs_date") >= F.to_date(F.lit(start))), ready, "station_id", how="left_semi")


def qualified_stations(ready: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct names of the stations that passed ``model_ready``."""
    ids = ready.select("station_id").distinct()
    return join_dim(ids, _names(stations), "station_id").select("station_name").distinct()
