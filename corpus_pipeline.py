"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. ``run`` writes each result as Parquet to the shared folder and reads it
again as the next stage's ``docs``. The last stage returns the token digests;
the others return the columns of ``documents``. A document that the mix takes
twice is there twice, and is encoded twice.

A stage's intermediate tables are deleted when a later stage begins, unless the
documents handed to that one still read them: the result of a stage has to be
written before the next one is called, as ``run`` does.

Defined results: a document without text fails the quality rules, as all short
ones do; repeated rows are scored alike, and near-duplicates keep one row of each
doc_id; rows without a doc_id stay until the mix; other columns of any name are
handed on by all stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import sys

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import public_tokenizers  # noqa: E402

from stationlake.llm import bpe, line_dedup, mixing, near_dedup, quality_rules  # noqa: E402
from stationlake.llm.common import read_table, stored  # noqa: E402
from stationlake.session import drop_tables, written  # noqa: E402


_LEFT: list[str] = []  # tables of the stages before


def _stage(function):
    """``function``, which first deletes the tables that earlier stages left and ``docs`` doesn't read."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        idle = [p for p in _LEFT if not any(p in f for f in read)]
        drop_tables(spark, idle)
        _LEFT[:] = [p for p in _LEFT if p not in idle]
        before = set(written())
        out = function(spark, docs, sf_dir)
        _LEFT.extend(p for p in written() if p not in before)
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.keep_lines(docs)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-duplicates", near), ("mixing", mixed),
          ("byte-level BPE", tokens)]

#: Line dedup's earlier copies could be put in SQL, but near-duplicates by similarity and the random rounding of the
#: mix can't be at this size; tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before = set(written())
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
        _LEFT.extend(p for p in written() if p not in before and p not in _LEFT)
    return docs
