"""Several tables in one commit: versions of a warehouse folder, published by a manifest.

A version's tables are written into a folder of their own; nothing that a reader sees
changes meanwhile. Contracts are checked on the written tables. Then one manifest file,
which names the folders of every table, is put into the log by a rename that fails where
the version number is taken: from then on readers resolve the new version, all tables at
once. A load that fails before (a broken contract, a lost job, a crash) leaves the old
version in force and at most an unreferenced folder, which ``vacuum`` removes. Two
loads that start from the same version can't both publish: the later one gets a
``Conflict`` and may start again from the new state.

Appended rows are new folders beside the old ones; no old file is rewritten.

    root/log/000000000007.json     {"version": 7, "at": ..., "tables": {name: {...}}}
    root/versions/<id>/<table>/     Parquet files
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators.quality import enforce
from stationlake.schema import Contract


class Conflict(RuntimeError):
    """Another load has published since this one read its base version."""


class _Files:
    """The Hadoop file system of one folder: the few calls that a log needs."""

    def __init__(self, spark: SparkSession, root: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def names(self, folder: str) -> list[str]:
        there = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(there)) if self.fs.exists(there) else []

    def delete(self, name: str) -> bool:
        return bool(self.fs.delete(self.path(name), True))

    def put(self, name: str, text: str) -> bool:
        """Write the whole file or nothing; False if there is one of this name."""
        target = self.path(name)
        draft = self.path(f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(draft, target, self.gateway.new_array(self.hadoop.Options.Rename, 0))
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return False
        return True


def _log_name(root: str, version: int) -> str:
    return f"{root}/log/{version:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions, oldest first."""
    names = _Files(spark, root).names(f"{root.rstrip('/')}/log")
    return [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The manifest of ``version`` (the latest); None where nothing is published."""
    root = root.rstrip("/")
    if version is None:
        there = versions(spark, root)
        if not there:
            return None
        version = there[-1]
    return json.loads(spark.read.text(_log_name(root, version), wholetext=True).first()[0])


def _open(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    if entry.get("catalog"):
        return spark.table(entry["catalog"])
    schema = T.StructType.fromJson(entry["schema"])
    parts = [spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{f}").select(*schema.fieldNames()) for f in entry["folders"]]
    return reduce(DataFrame.unionByName, parts)


def read(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """Every table of ``version`` (the latest), by name; empty where nothing is published."""
    found = manifest(spark, root, version)
    return {name: _open(spark, root, e) for name, e in (found or {"tables": {}})["tables"].items()}


def history(spark: SparkSession, root: str) -> DataFrame:
    """version, published_at, table_name, row_count, n_folders: one row a table and version, from the log alone."""
    log = spark.read.text(f"{root.rstrip('/')}/log/*.json", wholetext=True)
    kind = "version BIGINT, at STRING, tables MAP<STRING, STRUCT<rows: BIGINT, folders: ARRAY<STRING>>>"
    x = log.select(F.from_json("value", kind).alias("m")).select("m.version", F.col("m.at").alias("published_at"),
                                                                  F.explode("m.tables").alias("table_name", "t"))
    return x.select("version", "published_at", "table_name", F.col("t.rows").alias("row_count"),
                    F.size("t.folders").alias("n_folders"))


class Load:
    """One load: ``write`` tables, then ``publish`` them together. As a context manager it publishes at its end, or
    removes what it has written if the block fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), _Files(spark, root)
        self.base = manifest(spark, root) or {"version": 0, "tables": {}}
        self.folder = f"versions/{uuid.uuid4().hex[:16]}"
        self.entries: dict[str, dict] = {}
        self.contracts: dict[str, Contract] = {}
        self.version: int | None = None

    def __enter__(self) -> Load:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            try:
                self.publish()
            except BaseException:
                self.discard()
                raise
        else:
            self.discard()

    def write(self, name: str, df: DataFrame, contract: Contract | None = None, append: bool = False,
              partition_by: Sequence[str] = (), sort_within: Sequence[str] = (), range_by: Sequence[str] = (),
              buckets: tuple[str, str, int] | None = None) -> DataFrame:
        """Write ``df`` as the version's table ``name`` and return it as stored.

        ``append`` keeps the rows of the base version in front (same columns). ``range_by`` deals the rows out in ranges
        of these columns, sorted, so that a reader's predicates on them skip most files and row groups. ``buckets``
        (table prefix, column, number) saves it hash-partitioned in the session's catalog.
        """
        from stationlake.sources import sinks

        folder = f"{self.folder}/{name}"
        entry = {"folders": [folder], "schema": json.loads(df.schema.json()), "catalog": None}
        old = self.base["tables"].get(name) if append else None
        if old and (old["catalog"] or buckets):
            raise ValueError(f"{name}: a bucketed table can't be appended to")
        if buckets:
            prefix, column, n = buckets
            entry["catalog"] = f"{prefix}_{name}_{self.folder.rpartition('/')[2]}"
            sinks.write_bucketed(df, entry["catalog"], f"{self.root}/{folder}", column, n, sort_by=sort_within)
        else:
            sinks.write_table(df, f"{self.root}/{folder}", partition_by=partition_by, sort_within=sort_within, range_by=range_by)
        if old:
            names = [f["name"] for f in old["schema"]["fields"]]
            if sorted(names) != sorted(df.columns):
                raise ValueError(f"{name}: appended columns differ from {names}")
            entry["folders"] = [*old["folders"], folder]
            entry["schema"] = old["schema"]
        self.entries[name] = entry
        if contract:
            self.contracts[name] = contract
        return _open(self.spark, self.root, entry)

    def tables(self) -> dict[str, DataFrame]:
        """The tables as they will be: those written here, and the base version's others."""
        return {n: _open(self.spark, self.root, e) for n, e in {**self.base["tables"], **self.entries}.items()}

    def check(self) -> None:
        """Every contract of the written tables, on what is written (ContractError otherwise)."""
        tables = self.tables()
        for name, contract in self.contracts.items():
            enforce(tables[name], contract, tables)

    def publish(self) -> int:
        """Check, count, and put the manifest into the log: the one step that readers see."""
        self.check()
        for name, entry in self.entries.items():
            entry["rows"] = _open(self.spark, self.root, entry).count()
        number = self.base["version"] + 1
        text = json.dumps({"version": number, "at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
                           "tables": {**self.base["tables"], **self.entries}}, indent=1, sort_keys=True)
        if not self.files.put(_log_name(self.root, number), text):
            raise Conflict(f"{self.root}: version {number} was published by another load")
        self.version = number
        return number

    def discard(self) -> None:
        """Remove what this load has written, unless it is published."""
        if self.version is None:
            for entry in self.entries.values():
                if entry["catalog"]:
                    self.spark.sql(f"DROP TABLE IF EXISTS `{entry['catalog']}`")
            self.files.delete(f"{self.root}/{self.folder}")


def load_counts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Load report of a version (the latest): table_name, row_count, from its manifest."""
    found = manifest(spark, root, version) or {"tables": {}}
    return spark.createDataFrame([(n, e["rows"]) for n, e in sorted(found["tables"].items())], "table_name string, row_count bigint")


def load_staged(spark: SparkSession, root: str, sources: dict[str, str], contracts: dict[str, Contract],
                append: bool = True, strict: bool = True) -> int:
    """Load staged CSV files (table name -> path) in one commit; returns the version.

    Each file's own header names its columns. Every table of the load is checked against its contract together with the
    rows that are there already, references included; one broken rule leaves all tables as they were.
    """
    from stationlake.sources.sinks import bulk_load

    with Load(spark, root) as load:
        for name, path in sources.items():
            rows = bulk_load(spark, path, contracts[name], strict, check=False)
            load.write(name, rows, contracts[name] if strict else None, append=append)
    return load.version


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete manifests before the last ``keep`` versions and the folders that no kept one names; returns the number of
    folders. Not while a load runs: its folder has no manifest yet."""
    root, files = root.rstrip("/"), _Files(spark, root)
    there = versions(spark, root)
    kept = [manifest(spark, root, v) for v in there[-keep:]]
    used = {f.split("/")[1] for m in kept for e in m["tables"].values() for f in e["folders"]}
    for v in there[:-keep]:
        files.delete(_log_name(root, v))
    return sum(files.delete(f"{root}/versions/{n}") for n in files.names(f"{root}/versions") if n not in used)
