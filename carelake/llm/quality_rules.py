"""Quality rules of documents and of their hosts.

Each document is measured once; a rule is a comparison of its counts.  By host, the failures of each rule are
summed; failure rates are shrunk with a beta prior fitted to all hosts, so a host with few documents leans on the
others; a host one of whose shrunk rates is over a half is rejected, and the verdict is joined back.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import WORD_RE, materialize, text_key

#: Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Rates of the further host rules: symbols for 100 words, repeated lines for 100 lines.
MAX_SYMBOL_PERCENT = 50
MAX_DUP_LINE_PERCENT = 50
#: Shrunk failure rate over which a host is rejected.
HOST_RATE = 0.5
#: Bounds of the prior's weight in documents.
PRIOR_WEIGHT = (1.0, 1000000.0)

_words = re.compile(WORD_RE).findall
_symbols = str.maketrans("", "", "#*$%&|<>")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words which occurs twice or more in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # identities of runs of 1, 2, 4, ... words from those of half the length, then of the window
    size, runs = 1, ids
    while size < window:
        step = min(size, window - size)
        m = len(runs) - step
        both = runs[:m] * (int(runs.max()) + 1) + runs[step : step + m]
        runs = np.unique(both, return_inverse=True)[1]
        size += step
    twice = np.flatnonzero(np.bincount(runs)[runs] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[twice] += 1
    edge[twice + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of one text (null: no word)."""
    text = text or ""
    words = _words(text)
    seen, dup = set(), 0
    lines = text.split("\n")
    for line in lines:
        if line in seen:
            dup += bool(_words(line))
        else:
            seen.add(line)
    chars = sum(map(len, words))
    return len(words), chars, len(text) - len(text.translate(_symbols)), dup, repeated_words(words), len(lines)


def measure_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, tkey, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)`` of each row."""
    names = ["doc_id", "tkey", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def run(batches):
        for b in batches:
            got = np.array([measures(t.as_py()) for t in b.column(3)], np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(got[:, i]) for i in range(6))], names)

    rows = docs.select("doc_id", text_key(F.col("text")).alias("tkey"), F.col("source").alias("host"), "text")
    kinds = [f.dataType.simpleString() for f in rows.schema][:3] + ["long"] * 6
    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def rules() -> dict[str, Column]:
    """Name -> true where a measured document fails the rule."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT,
        "symbols": F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOL_PERCENT,
        "dup_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT,
    }


def host_verdicts(measured: DataFrame) -> DataFrame:
    """``(host, n_docs, rate_<rule>..., rejected)``, a row for each host that is not null.

    For each rule the prior Beta(m k, (1 - m) k) is fitted by moments: m is the rate over all documents, and
    k = m (1 - m) / v - 1 with v the spread of the hosts' rates, weighted by their documents and held in
    PRIOR_WEIGHT.  A host's shrunk rate is (failures + m k) / (documents + k).
    """
    by = measured.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n_docs"), *(F.sum(r.cast("long")).alias(f"f_{k}") for k, r in rules().items())
    )
    by = materialize(by, "hosts")
    low, high = PRIOR_WEIGHT
    priors = by.agg(
        F.sum("n_docs").alias("n"),
        *(F.sum(f"f_{k}").alias(f"f_{k}") for k in rules()),
        *(F.sum(F.col(f"f_{k}") * F.col(f"f_{k}") / F.col("n_docs")).alias(f"q_{k}") for k in rules()),
    ).first()
    shrunk = {}
    for k in rules():
        n = priors["n"] or 0
        m = (priors[f"f_{k}"] or 0) / n if n else 0.0
        v = (priors[f"q_{k}"] or 0) / n - m * m if n else 0.0
        weight = min(max(m * (1 - m) / v - 1, low), high) if v > 0 else high
        shrunk[k] = (F.col(f"f_{k}") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight))
    rates = by.select("host", "n_docs", *(c.alias(f"rate_{k}") for k, c in shrunk.items()))
    return rates.withColumn("rejected", F.greatest(*(F.col(f"rate_{k}") for k in shrunk)) > F.lit(HOST_RATE))


def judge_documents(docs: DataFrame) -> DataFrame:
    """Measures of every row plus ``base_failed``, ``host_rejected`` and ``kept``.

    A null text has no word and fails the base rules; a row without a host is judged by its own text alone;
    repeated rows are measured and counted each; an empty table gives no rows.  Host counts are combined before
    the shuffle, and verdicts are joined on the host (an ordinary join, so a hot host is split or broadcast by size).
    """
    m = materialize(measure_documents(docs), "measures")
    base = rules()["short"] | rules()["repeats"]
    rejected = host_verdicts(m).where("rejected").select("host", F.lit(True).alias("host_rejected"))
    return (
        m.withColumn("base_failed", base)
        .join(rejected, "host", "left")
        .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that judge_documents() keeps, all columns as they were."""
    bad = judge_documents(docs).where("not kept").select(
        F.col("doc_id").alias("b_id"), F.col("tkey").alias("b_key"), F.col("host").alias("b_host")
    )
    d, bad = docs.alias("d"), materialize(bad.distinct(), "rejected").alias("b")
    same = (
        F.col("d.doc_id").eqNullSafe(F.col("b.b_id"))
        & (text_key(F.col("d.text")) == F.col("b.b_key"))
        & F.col("d.source").eqNullSafe(F.col("b.b_host"))
    )
    return d.join(bad, same, "left_anti")
