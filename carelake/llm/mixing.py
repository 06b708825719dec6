"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Documents of a source are served in a shuffled order, up to three times each.  A document's virtual finish time is
the source's words up to its end divided by the source's target, so sources advance in proportion to their targets.
Served runs are ordered by finish time over all sources, and the mix ends where the total budget is spent.  Service
is by word: the run that crosses its source's target (time one) is cut there.

Running sums, over the sources, a hot source or all runs, never go through one task: ranged() sorts by ranges of about
equal rows, accumulates the few range sums, and accumulates rows inside their range only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import WORD_RE, free_names, materialize, text_key

#: Times a document may be taken.
MAX_EPOCHS = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)


def ranged(rows: DataFrame, order: list[str], *sums: str) -> DataFrame:
    """``rows`` and, for each column of ``sums``, ``<column>_before``: its sum over all rows earlier in ``order``.

    ``order`` tells all rows apart, so Spark's sampled ranges hold about equal rows whatever repeats.  They are written
    with their number before anything is summed, so a lost executor can't move a row.  One row for each range meets in a
    task, as many as the shuffle has partitions.
    """
    cut = materialize(rows.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "ranged")
    earlier = Window.partitionBy(F.lit(0)).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy("pid").agg(*(F.sum(c).alias(c) for c in sums))
    parts = parts.select("pid", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in sums))
    for c in sums:
        cut = cut.withColumn(f"{c}_in", F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return cut.join(parts, "pid").select(
        *rows.columns, *((F.col(f"{c}_start") + F.col(f"{c}_in")).alias(f"{c}_before") for c in sums)
    )


def sized_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, tkey, skey, size, okey)``: source key in code point order with null last, words, shuffle key."""
    return docs.select(
        "doc_id",
        text_key(F.col("text")).alias("tkey"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t")).alias("skey"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("okey"),
    )


def source_targets(sized: DataFrame) -> DataFrame:
    """``(skey, source_size, source_start, total, target)``, a row for each source; source_start: sizes of those before.

    A target is min(weight * level, 3 * size): the level at which the targets sum to all sizes is what resharing
    the excess by weight ends at.  With sources in order of 3 * size / weight, it is found where the sources before
    are full and this one is not.  Any number of sources: the driver gets their sums and the level only.
    """
    cases = F.lit(WEIGHTS[-1])
    for i, w in enumerate(WEIGHTS[:-1]):
        cases = F.when(F.col("one_before") % len(WEIGHTS) == i, w).otherwise(cases)
    s = sized.groupBy("skey").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    s = ranged(s, ["skey"], "one", "source_size").withColumn("w", cases.cast("long"))
    s = s.withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    s = s.withColumn("full_at", F.col("cap").cast("double") / F.col("w"))
    s = ranged(s, ["full_at", "skey"], "cap", "w")
    every = s.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    total, weight = (F.lit(every[c] or 0).cast("long") for c in ("size", "w"))
    level = (total - F.col("cap_before")).cast("double") / (weight - F.col("w_before"))
    found = s.agg(F.max(F.when(level <= F.col("full_at"), level))).first()[0]
    target = F.least(F.col("w") * F.lit(found).cast("double"), F.col("cap").cast("double"))
    return s.select(
        "skey", "source_size", F.col("source_size_before").alias("source_start"), total.alias("total"), target.alias("target")
    )


def mix(docs: DataFrame) -> DataFrame:
    """``(doc_id, tkey, skey, size, source_size, target, start, taken)``, one row per row of ``docs``.

    ``taken`` counts the words the mix takes of the row, repeats included: floor(taken / size) whole times and the
    first ``taken % size`` words once more, which happens to one row of a source at most.  Null text: size 0, never
    taken.  A null source is a source of its own, last in order.  The shuffle orders by md5 of doc_id, then doc_id,
    size and text, so reruns agree; rows that repeat all of these are interchangeable, and a number written with each
    of them lets their ranges be divided.  Empty table: no rows.
    """
    rows = materialize(sized_documents(docs).withColumn("salt", F.monotonically_increasing_id()), "sized")
    sources = materialize(source_targets(rows), "sources")
    placed = (
        ranged(rows, ["skey", "okey", "doc_id", "size", "tkey", "salt"], "size")
        .join(sources, "skey")
        .withColumn("start", F.col("size_before") - F.col("source_start"))
        .select("doc_id", "tkey", "skey", "size", "source_size", "total", "target", "start")
    )
    placed = materialize(placed, "placed")

    wanted = F.least(F.ceil("target"), F.col("source_size") * MAX_EPOCHS)
    runs = (
        placed.where("size > 0")
        .withColumn("epoch", F.explode(F.array(*(F.lit(i) for i in range(MAX_EPOCHS)))))
        .withColumn("at", F.col("start") + F.col("epoch") * F.col("source_size"))
        .withColumn("words", F.least(F.col("size"), wanted - F.col("at")))
        .where("words > 0")
        .withColumn("finish", (F.col("at") + F.col("words")).cast("double") / F.col("target"))
        .select("skey", "start", "at", "words", "finish", "total")
    )
    served = (
        ranged(runs, ["finish", "skey", "at"], "words")
        .withColumn("served", F.least("words", F.greatest(F.lit(0), F.col("total") - F.col("words_before"))))
        .groupBy("skey", "start")
        .agg(F.sum("served").alias("served"))
    )
    out = placed.join(served, ["skey", "start"], "left")
    taken = F.when(F.col("size") > 0, F.coalesce("served", F.lit(0))).otherwise(F.lit(0))
    return out.select(
        "doc_id", "tkey", "skey", "size", "source_size", "target", "start", taken.cast("long").alias("taken")
    )


def apply_mix(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix serves it: a row as many times as it is taken whole, and once more with its first words
    if the mix ends inside it.  Columns stay as they were; rows that are not taken go."""
    m = mix(docs).where("taken > 0").select(
        F.col("doc_id").alias("m_id"), F.col("tkey").alias("m_key"), F.col("skey").alias("m_skey"), "size", "taken"
    )
    skey = F.coalesce(F.concat(F.lit("s"), F.col("d.source").cast("string")), F.lit("t"))
    # rows that repeat doc_id, text and source share what the mix takes of them: one row each, its count beside it
    same = m.groupBy("m_id", "m_key", "m_skey", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("n"))
    d = docs.alias("d").join(
        same.alias("m"),
        F.col("d.doc_id").eqNullSafe(F.col("m_id"))
        & (text_key(F.col("d.text")) == F.col("m_key"))
        & (skey == F.col("m_skey")),
    )
    size, taken, key, copy, words = free_names(docs.columns, "size", "taken", "tkey", "copy", "words")
    keep = [F.col(f"d.`{c}`") for c in docs.columns]
    d = d.select(*keep, F.col("m.size").alias(size), F.col("m.taken").alias(taken), F.col("m.m_key").alias(key))
    once = d.dropDuplicates(["doc_id", key, "source"])
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col(taken) / F.col(size))))
    out = once.withColumn(copy, copies).withColumn(
        words, F.least(F.col(size), F.col(taken) - (F.col(copy) - 1) * F.col(size))
    )
    spaced = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD_RE), F.lit(0))
    first = F.array_join(F.slice(spaced, F.lit(1), F.col(words).cast("int")), "")
    text = F.when(F.col(words) == F.col(size), F.col("text")).otherwise(first)
    return out.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
