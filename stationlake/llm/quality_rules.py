"""Quality rules with verdicts on hosts.

Every document gets its counts and the rules it breaks. Failures are summed by
host (``host_col``), each host's failure rate is shrunk towards the corpus by a
beta prior fitted to all hosts (method of moments), and a host whose shrunk rate
is above ``max_host_rate`` fails as a whole; its verdict is joined back to its
documents. A host of few documents stays close to the corpus rate, so it isn't
rejected for one bad page.

Defined results: a null text has no words; a null host is a host of its own that
is never rejected; repeated rows count each time; a document is kept when it
passes the base rules and its host passes; an empty table gives an empty result.
Input columns named like a count are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import add_columns, hinted, stored

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
MAX_HOST_RATE = 0.5

COUNTS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_lines", "bigint"),
          ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("n_rules_failed", "int")]

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_MIX = 0x9E3779B97F4A7C15


def repeat_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words inside a window of ``width`` words that is found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    h = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    # windows as class numbers, doubled in width: exact, without hashing
    step, cls = 1, h
    while step < width:
        grow = min(step, width - step)
        pair = cls[:len(cls) - grow] * (int(cls.max()) + 1) + cls[grow:]
        _, cls = np.unique(pair, return_inverse=True)
        step += grow
    twice = np.bincount(cls)[cls] > 1
    edge = np.zeros(len(words) + 1, np.int32)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count_texts(texts: list[bytes]) -> list[list]:
    """The columns of ``COUNTS`` for a batch of texts."""
    out: list[list] = [[] for _ in COUNTS]
    for b in texts:
        words = b.split()
        n = len(words)
        bare = b.translate(None, _SPACE)
        # code points: bytes that don't continue one
        chars = len(bare.decode("utf-8", "replace"))
        symbols = len(b) - len(b.translate(None, _SYMBOLS))
        seen, dup, lines = set(), 0, 0
        for line in b.split(b"\n"):
            if line.strip(_SPACE):
                lines += 1
                if line in seen:
                    dup += 1
                else:
                    seen.add(line)
        repeats = repeat_words(words)
        failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
        rules = ((n < MIN_WORDS) + (100 * repeats > REPEAT_PERCENT * n) + (100 * symbols > SYMBOL_PERCENT * chars)
                 + (100 * dup > DUP_LINE_PERCENT * lines))
        for col, v in zip(out, (n, chars, symbols, lines, dup, repeats, failed, rules)):
            col.append(v)
    return out


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS``."""
    return add_columns(docs, text_col, COUNTS, count_texts)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """alpha and beta by the method of moments over the rows (n_docs, n_failed) of ``hosts``.

    The spread between hosts is what remains of the variance of the rates after
    binomial noise; without any, the prior is so strong that all hosts share the
    corpus rate.
    """
    r = (hosts.withColumn("p", F.col("n_failed") / F.col("n_docs"))
         .agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count(F.lit(1)).alias("h"),
              F.avg("p").alias("m"), F.var_pop("p").alias("v"), F.avg(1 / F.col("n_docs")).alias("inv")).first())
    if not r["n"]:
        return 1.0, 1.0
    mean = r["f"] / r["n"]
    spread = (r["v"] or 0.0) - mean * (1 - mean) * r["inv"]
    strength = mean * (1 - mean) / spread - 1 if spread > 1e-12 and 0 < mean < 1 else 1e9
    strength = min(max(strength, 1e-3), 1e9)
    # a corpus where nothing or all fails still gets a proper prior
    mean = min(max(mean, 1e-9), 1 - 1e-9)
    assert math.isfinite(strength)
    return mean * strength, (1 - mean) * strength


def host_verdicts(measured: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, host_rate (posterior mean), host_failed: one row a host, null host left out."""
    hosts = stored(measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host"))
                   .agg(F.count(F.lit(1)).alias("n_docs"),
                        F.sum((F.col("n_rules_failed") > 0).cast("bigint")).alias("n_failed")), "hosts")
    a, b = beta_prior(hosts)
    rate = (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    return hosts.withColumn("host_rate", rate).withColumn("host_failed", F.col("host_rate") > max_host_rate)


def judged(measured: DataFrame, verdicts: DataFrame, host_col: str = "source") -> DataFrame:
    """``measured`` with ``host_rate``, ``host_failed`` and ``kept``."""
    v = hinted(verdicts.select(F.col("host").alias("_host"), "host_rate", "host_failed"))
    return (measured.drop("host_rate", "host_failed", "kept").join(v, F.col(host_col) == F.col("_host"), "left")
            .drop("_host").withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def quality(docs: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row a document: doc_id, host column, counts and verdicts (texts are not carried)."""
    slim = measure(docs.select("doc_id", host_col, "text"))
    slim = stored(slim.drop("text"), "quality")
    return judged(slim, host_verdicts(slim, host_col, max_host_rate), host_col)


def keep_good(docs: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with its own columns.

    The counts are taken twice, once for the hosts' sums and once beside the
    texts: that is cheaper than a shuffle of all texts to join verdicts to them.
    """
    columns = docs.columns
    slim = measure(docs.select(F.col(host_col), "text")).drop("text")
    verdicts = host_verdicts(slim, host_col, max_host_rate)
    names = {n for n, _ in COUNTS} | {"host_rate", "host_failed", "kept", "_host"}
    safe = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}" if c not in ("text", host_col) or c in names else c)
                         for i, c in enumerate(columns)])
    out = judged(measure(safe), verdicts, host_col).where("kept")
    return out.select(*[F.col(s).alias(c) for s, c in zip(safe.columns, columns)])
