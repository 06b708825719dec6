"""SimHash near-duplicate groups by segment popcounts.

A fingerprint has 64 bits.  Cut into 32 segments of two bits, its *embedding* is the count of set bits of each
segment.  Flipping a bit moves one count by one, so the Manhattan distance of two embeddings is at most the
Hamming distance of the fingerprints: a lower bound that never loses a link.

Grid range-join.  Counts live on an integer grid.  Two embeddings within distance 2 both lie within distance 1 of
some grid cell (their midpoint), so each distinct fingerprint registers in its own cell and the cells one step
away, and candidates are the fingerprints that share a cell.  Nothing is paired: a cell only has to know whether
it holds more than one fingerprint, which is a combinable aggregate.

Exact check.  Two fingerprints differ in at most 2 bits exactly if some 64-bit value (the *midpoint*) differs from
each in at most 1.  Candidates register at their midpoints, and those that meet there are linked to the smallest
one: links grow with the candidates and not with the square of a group, and components equal those of all pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import free_names, materialize, text_key
from carelake.llm.components import connected_components

SEED = 42
#: More and shorter segments make a sharper bound: two bits tell random fingerprints apart at any corpus size.
SEGMENT_BITS = 2
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of one text: bit set if set in over half the shingle hashes.  No word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[at : at + _CHUNK]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, tkey, fp)`` of every row; fp is the fingerprint's bits as a long.  Null text: no word."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "tkey", "fp"]
            )

    rows = docs.select("doc_id", text_key(F.col("text")).alias("tkey"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, tkey long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedding(fp: Column) -> Column:
    """Set bits of each of the 32 two-bit segments, packed in one long: a count (0 to 2) takes its segment's place."""
    ones = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(ones), F.shiftrightunsigned(fp, 1).bitwiseAND(ones)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _cells(emb: Column) -> Column:
    """The cell of an embedding and every cell one step away inside the grid (null where there is none)."""
    out = [emb]
    for at in range(0, 64, SEGMENT_BITS):
        count = F.shiftrightunsigned(emb, at).bitwiseAND(F.lit(3).cast("long"))
        cleared = emb.bitwiseAND(F.lit(_signed(((1 << 64) - 1) ^ (3 << at))))
        for step, ok in ((1, count < SEGMENT_BITS), (-1, count > 0)):
            out.append(F.when(ok, cleared.bitwiseOR(F.shiftleft(count + step, at))))
    return F.array(*out)


def links(fps: DataFrame) -> DataFrame:
    """``(u, v)``: links whose components are those of all distinct ``fps(fp)`` at 2 or fewer differing bits."""
    cells = fps.select("fp", embedding(F.col("fp")).alias("emb")).select(
        "fp", F.explode(_cells(F.col("emb"))).alias("cell")
    ).where("cell is not null")
    shared = cells.groupBy("cell").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("cell")
    near = materialize(cells.join(shared, "cell", "left_semi").select("fp").distinct(), "near")
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << j))) for j in range(64)]
    mids = near.select("fp", F.explode(F.array(*flips)).alias("mid"))
    met = mids.groupBy("mid").agg(F.min("fp").alias("v"), F.max("fp").alias("w")).where("v < w").select("mid", "v")
    return mids.join(met, "mid").where("fp != v").select(F.col("fp").alias("u"), "v")


def simhash_groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, tkey, fp, root, component_id)``, one row per row of ``docs``.

    Fingerprints that differ in at most 2 bits are linked; ``component_id`` is the smallest doc_id reachable (null
    only if every doc_id of the component is), ``root`` its smallest fingerprint.  A text without words has
    fingerprint 0 and is linked like any other; repeated rows keep their rows; an empty table gives no rows.
    Very long texts are hashed in chunks of shingles.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    by_fp = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "by_fp")
    roots = connected_components(links(by_fp.select("fp"))).withColumnRenamed("node", "fp")
    rooted = by_fp.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = materialize(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(ids, "fp").select("doc_id", "tkey", "fp", "root", "component_id")


def hex_of(fp: Column) -> Column:
    """A long's bits as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the row of the smallest doc_id stays (null
    ids last, then the smaller text key); of rows that repeat it in doc_id and text, one."""
    g = simhash_groups(docs, shingle)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("tkey").alias("k"))
    best = materialize(g.groupBy("root").agg(F.min(order).alias("o")).select("o.d", "o.k"), "kept")
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    d = docs.alias("d").join(
        best.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.d")) & (text_key(F.col("d.text")) == F.col("b.k"))
    )
    (key,) = free_names(docs.columns, "key")
    return d.select(*names, F.col("b.k").alias(key)).dropDuplicates(["doc_id", key]).drop(key)
