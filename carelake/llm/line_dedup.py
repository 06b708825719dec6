"""Line dedup: keys of lines, range-partitioned and streamed in order of key, document and position.

Long lines are keyed by 128 bits of their normal form.  Rows (key, document, position) are range-partitioned by all
three and sorted inside partitions, documents from the largest id down, so the first document of a key is the one
that keeps its lines, and a key that holds a third of all rows spreads over many partitions.  A partition is streamed
once: the state is the current key, its first two documents and the lines of the second, which wait until a third
document shows up or the key ends.  Keys that cross a partition's edge are settled beforehand from the first and last
run of each partition, which is a row or two for each partition.  The result is a bitmap of kept lines for each document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import checkpointed, free_names, materialize, text_key

MIN_CHARS = 20
MIN_DOCS = 3
#: Stands for a null doc_id: smaller than any other.
_NULL_ID = -(1 << 63)
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(k1, k2, doc, tkey, pos)`` of the lines long enough to count; k1 and k2 are the halves of the key's md5."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"),
        text_key(F.col("text")).alias("tkey"),
        F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    key = F.translate(F.trim(F.col("line"), F.lit(_SPACE)), _UPPER, _LOWER)
    half = lambda at: F.expr(f"cast(conv(substr(m, {at}, 16), 16, -10) as bigint)")
    return (
        lines.withColumn("key", key)
        .where(F.char_length("key") >= min_chars)
        .withColumn("m", F.md5("key"))
        .select(half(1).alias("k1"), half(17).alias("k2"), "doc", "tkey", "pos")
    )


def _edges(batches):
    """For a partition: of its first and its last key, up to MIN_DOCS largest documents."""
    first = last = None
    docs: list[int] = []
    out = []
    for b in batches:
        k1, k2, doc = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(k1):
            continue
        cut = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
        starts = np.concatenate(([0], cut))
        ends = np.concatenate((cut, [len(k1)]))
        for which in sorted({0, len(starts) - 1}):
            s, e = starts[which], ends[which]
            key = (int(k1[s]), int(k2[s]))
            if key != last:
                if last is not None and last == first:
                    out.append((*first, docs))
                last, docs = key, []
                first = first or key
            new = doc[s:e]
            new = new[np.concatenate(([True], new[1:] != new[:-1]))][: MIN_DOCS + 1]
            docs = docs + [int(x) for x in new if not docs or int(x) != docs[-1]]
            docs = docs[:MIN_DOCS]
    if last is not None:
        out.append((*last, docs))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([x[0] for x in out], pa.int64()),
            pa.array([x[1] for x in out], pa.int64()),
            pa.array([x[2] for x in out], pa.list_(pa.int64())),
        ],
        ["k1", "k2", "docs"],
    )


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc, tkey, pos)`` of the lines to drop, from ``keyed_lines()``."""
    if min_docs != MIN_DOCS:
        raise ValueError(f"min_docs is fixed at {MIN_DOCS}")
    order = [F.col("k1").asc(), F.col("k2").asc(), F.col("doc").desc(), F.col("pos").asc()]
    lines = materialize(lines, "lines")  # the range sampling reads them once more
    ranged = checkpointed(lines.repartitionByRange(*order).sortWithinPartitions(*order).select("k1", "k2", "doc", "tkey", "pos"))
    edges = ranged.select("k1", "k2", "doc").mapInArrow(_edges, "k1 long, k2 long, docs array<long>")
    settled: dict[tuple[int, int], list[int]] = {}
    for r in edges.collect():  # two rows of at most MIN_DOCS ids for each partition
        settled[r.k1, r.k2] = sorted({*settled.get((r.k1, r.k2), []), *r.docs}, reverse=True)[:MIN_DOCS]
    known = ranged.sparkSession.sparkContext.broadcast(settled)

    def run(batches):
        edge = known.value
        key, top, second, full, waiting = None, None, None, False, []
        for b in batches:
            k1, k2, doc, tkey, pos = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            n = len(k1)
            if not n:
                continue
            new = np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (doc[1:] != doc[:-1])))
            starts = np.flatnonzero(new).tolist() + [n]
            drop = []  # (doc, tkey, pos) arrays
            for s, e in zip(starts, starts[1:]):
                k, d = (int(k1[s]), int(k2[s])), int(doc[s])
                if k != key:
                    key, waiting = k, []
                    top, second, full = d, None, False
                    if k in edge:
                        ids = edge[k]
                        top, full = ids[0], len(ids) == MIN_DOCS
                        second = ids[1] if len(ids) > 1 else None
                if d == top:
                    continue
                rows = (doc[s:e], tkey[s:e], pos[s:e])
                if full:
                    drop.append(rows)
                elif k in edge:
                    continue
                elif second is None or d == second:
                    second = d
                    waiting.append(rows)
                else:
                    full = True
                    drop += [*waiting, rows]
                    waiting = []
            if drop:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[i] for x in drop])) for i in range(3)], ["doc", "tkey", "pos"]
                )

    return ranged.mapInArrow(run, "doc long, tkey long, pos int")


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """``(doc, tkey, keep)`` for the documents that lose lines: ``keep`` is a zlib-compressed bitmap, bit i of byte
    i // 8 from the high end set if line i stays; lines past the bitmap stay.  Documents that lose none have no row."""
    lost = dropped_lines(keyed_lines(docs)).groupBy("doc", "tkey").agg(F.collect_set("pos").alias("pos"))

    def run(batches):
        for b in batches:
            maps = []
            for x in b.column(2):
                gone = np.array(x.as_py(), np.int64)
                bits = np.ones((int(gone.max()) // 8 + 1) * 8, np.uint8)
                bits[gone] = 0
                maps.append(zlib.compress(np.packbits(bits).tobytes(), 6))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(maps, pa.binary())], ["doc", "tkey", "keep"])

    return lost.mapInArrow(run, "doc long, tkey long, keep binary")


def kept_mask(n_lines: int, keep: bytes | None) -> np.ndarray:
    """Of n lines, true for those that stay."""
    out = np.ones(n_lines, bool)
    if keep is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n_lines].astype(bool)
        out[: len(bits)] = bits
    return out


def kept_text(text: str | None, keep: bytes | None) -> tuple[str, int, int]:
    """The lines that stay, joined; the lines there were; the lines dropped.  Null text: one empty line."""
    lines = (text or "").split("\n")
    if keep is None:
        return text or "", len(lines), 0
    mask = kept_mask(len(lines), keep)
    return "\n".join([x for x, k in zip(lines, mask.tolist()) if k]), len(lines), int(len(lines) - mask.sum())


def with_bitmaps(docs: DataFrame) -> DataFrame:
    """``docs`` with a last column ``keep`` (a longer name if ``docs`` has one): the row's bitmap, or null if it loses
    no line.

    Documents are told apart by doc_id (a null id counts as one document below all others); rows that repeat a
    doc_id with other text count as the same document but have their own bitmap.  Null or empty text is one empty
    line, which is too short to be dropped.  Empty table: no rows.
    """
    # merged at every size: what is lost grows with the documents, so nothing bounds a broadcast of it
    maps = materialize(keep_bitmaps(docs), "bitmaps").hint("merge").alias("b")
    d = docs.alias("d")
    same = (F.coalesce(F.col("d.doc_id").cast("long"), F.lit(_NULL_ID)) == F.col("b.doc")) & (
        text_key(F.col("d.text")) == F.col("b.tkey")
    )
    (keep,) = free_names(docs.columns, "keep")
    return d.join(maps, same, "left").select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("b.keep").alias(keep))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines gone from ``text``; all other columns and rows stay."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            keep = b.column(b.num_columns - 1)
            texts = [
                t.as_py() if not k.is_valid else kept_text(t.as_py(), k.as_py())[0] for t, k in zip(b.column(at), keep)
            ]
            cols = [c if i != at else pa.array(texts, c.type) for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return with_bitmaps(docs).mapInArrow(run, docs.schema)
