"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A bin is filled greedily, the longest document that fits first.  If a gap is left, the bin's smallest document is taken
out again for the two unpacked documents that fill the widened gap best, as long as this fills the bin further.

What a bin gets depends only on which lengths are still to be had, never on which document has one.  So bins are planned
over the histogram of lengths (``capacity`` counts, whatever the number of documents): a filling is repeated until one of
its lengths runs out, which is what filling bin after bin would do.  Documents then look up their place by their rank
among those of the same length.  Ranks come from counts by written part, so no length, however frequent, meets in a task.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Tokens in a sequence.
CAPACITY = 4096
#: Words in each of the two generations that a worker remembers.
MEMO = 400_000
#: Bytes of the longest word that is remembered.
LONGEST = 64
#: Bits of a rank in the key that places are looked up by.
RANK_BITS = 44


# ------------------------------------------------------------------ plan
def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fillings as ``(bins, [(length, copies in a bin), ...])``, lengths falling; they use up ``counts``.

    Lengths that are to be had are bits of an integer, and of another one mirrored, so the longest one that fits and the
    pairs of a given sum are found by shifts.
    """
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    here = sum(1 << i for i, n in enumerate(left) if n)
    mirror = sum(1 << (capacity - i) for i, n in enumerate(left) if n)
    out = []
    while here:
        gap, held, free, back = capacity, {}, here, mirror

        def take(length: int, n: int) -> None:
            nonlocal gap, free, back
            held[length] = held.get(length, 0) + n
            gap -= length * n
            if held[length] == left[length]:
                free &= ~(1 << length)
                back &= ~(1 << (capacity - length))

        while fits := free & ((1 << (gap + 1)) - 1):
            length = fits.bit_length() - 1
            take(length, min(left[length], gap // length))
        while gap and (len(held) > 1 or max(held.values()) > 1):
            smallest = min(held)
            pair = _best_pair(free, back, capacity, gap + smallest, smallest, lambda x: left[x] - held.get(x, 0))
            if pair is None:
                break
            held[smallest] -= 1
            if not held[smallest]:
                del held[smallest]
            free, back = free | 1 << smallest, back | 1 << (capacity - smallest)
            gap += smallest
            for length in pair:
                take(length, 1)
        bins = min(left[x] // n for x, n in held.items())
        for length, n in held.items():
            left[length] -= bins * n
            if not left[length]:
                here &= ~(1 << length)
                mirror &= ~(1 << (capacity - length))
        out.append((bins, sorted(held.items(), reverse=True)))
    return out


def _best_pair(free: int, back: int, capacity: int, most: int, least: int, unused) -> tuple[int, int] | None:
    """Two lengths of ``free`` whose sum is the largest up to ``most`` and over ``least``, the longest first."""
    if not free:
        return None
    lowest = (free & -free).bit_length() - 1
    for total in range(most, max(least, 2 * lowest - 1), -1):
        hits = free & (back >> (capacity - total))
        if hits and total % 2 == 0 and hits >> (total // 2) & 1 and unused(total // 2) < 2:
            hits &= ~(1 << (total // 2))
        if hits:
            long = hits.bit_length() - 1
            return long, total - long
    return None


def _places(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """The plan by (length, first rank): ``key``, and the first bin, copies in a bin and offset that start there."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for bins, held in plan:
        offset = 0
        for length, n in held:
            rank = used.get(length, 0)
            rows.append((length << RANK_BITS | rank, rank, first, n, offset))
            used[length] = rank + bins * n
            offset += length * n
        first += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("key", "rank", "bin", "copies", "offset"), table.T.copy()))


# ------------------------------------------------------------------ pack
def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (long): sequences of at most ``capacity``, each gapless from 0.

    Reads the column ``length``.  A length that is null, under 1 or over ``capacity`` has no place: both new columns are
    null.  Columns of ``items`` of the new names are replaced; others stay as they are.  Empty table: no rows.
    Documents of one length are interchangeable: which of them gets which place follows the order of the rows.

    Rows are written once, with their rank among the rows of their length in the same task.  The driver sees the
    histogram (``capacity`` numbers) and sends back the plan: a filling ends with one of its lengths too few for another
    such bin, so fillings are bounded by the capacity, not by the rows.
    """
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    part, rank, before = _free_names(names, "part", "rank", "before")
    items = items.select(*[F.col(f"`{c}`") for c in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)

    def ranked(batches):
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for b in batches:
            length = _lengths(b.column(names.index("length")), capacity)
            order = np.argsort(length, kind="stable")
            runs = length[order]
            starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(runs) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(runs)])
            within = np.empty(len(runs), np.int64)
            within[order] = np.arange(len(runs)) - np.repeat(starts, sizes) + np.repeat(seen[runs[starts]], sizes)
            seen[runs[starts]] += sizes
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(runs), task, np.int64)), pa.array(within)], [*names, part, rank]
            )

    rows = materialize(items.mapInArrow(ranked, f"{kinds}, `{part}` long, `{rank}` long"), "ranked")
    fits = F.col("length").between(1, capacity)
    counts = materialize(
        rows.where(fits).groupBy(part, F.col("length").cast("int").alias("length")).agg(F.count("*").alias("n")), "lengths"
    )
    total = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    places = rows.sparkSession.sparkContext.broadcast(_places(best_two_fit(total, capacity)))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select(
        F.col(part).alias("s_part"),
        F.col("length").alias("s_length"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before),
    )
    placed = rows.join(start, (F.col(part) == F.col("s_part")) & (F.col("length") == F.col("s_length")), "left")

    def place(batches):
        p = places.value
        for b in batches:
            length = _lengths(b.column(names.index("length")), capacity)
            ok = length > 0
            n = b.column(len(names)).to_numpy(zero_copy_only=False) + np.nan_to_num(
                b.column(len(names) + 1).to_numpy(zero_copy_only=False)
            ).astype(np.int64)
            at = np.searchsorted(p["key"], length << RANK_BITS | n, side="right") - 1
            at[~ok] = 0
            bins, places_ = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            if ok.any():
                q = n - p["rank"][at]
                bins = p["bin"][at] + q // p["copies"][at]
                places_ = p["offset"][at] + q % p["copies"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(names)], pa.array(bins, mask=~ok), pa.array(places_, mask=~ok)],
                [*names, "sequence_id", "offset"],
            )

    return placed.select(*[F.col(f"`{c}`") for c in names], rank, before).mapInArrow(
        place, f"{kinds}, sequence_id long, offset long"
    )


def _lengths(column: pa.Array, capacity: int) -> np.ndarray:
    """Lengths as long, 0 where there is no place."""
    x = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return np.where((x >= 1) & (x <= capacity), x, 0)


def _free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names that no column has (Spark compares names without case)."""
    low = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name in low:
            name += "_"
        low.add(name)
        out.append(name)
    return out


# ------------------------------------------------------------------ pieces
#: An ASCII letter or digit and the ASCII marks after it, up to a word's end.
_MARKS = re.compile(rb"(.*[A-Za-z0-9])([!-/:-@\[-`{-~]+)", re.DOTALL).fullmatch


#: Letters whose composed and lower-case forms are single characters again.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Byte-level vocabularies write bytes without a printable sign as the characters from U+0100 on, in order.
_BYTE_CHARS = dict(zip((i for i in range(256) if not (33 <= i <= 126 or 161 <= i <= 172 or i >= 174)), range(256, 512)))


class _Words(dict):
    """Word -> packed ids.  The vocabulary's rules never look past ASCII white space, so the words that it separates are
    encoded one by one by the library and remembered; when full, a generation becomes the older one.  Marks at a word's
    end are tokens of their own, and case is dropped, so both are taken off before the library is asked.  A word of
    Latin letters is one piece to the rules, so it goes to the library's merges as it is, byte by byte."""

    def __init__(self, tokenizer):
        self.encode, self.merge, self.old = tokenizer.encode, tokenizer.model.tokenize, {}

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()

    def __missing__(self, word: bytes) -> bytes:
        out = self.old.get(word)
        if out is None:
            low = word.lower() if word.isascii() else word
            if cut := _MARKS(low):
                out = self[cut[1]] + self[cut[2]]
            elif low != word:
                out = self[low]
            else:
                text = word.decode()
                if _LETTERS(text):
                    ids = [t.id for t in self.merge(text.lower().encode().decode("latin-1").translate(_BYTE_CHARS))]
                else:
                    ids = self.encode(text, add_special_tokens=False).ids
                out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST:
            self[word] = out
        return out


_WORDS: dict[str, _Words] = {}


def _words_of(tokenizer_file: bytes) -> _Words:
    key = hashlib.sha256(tokenizer_file).hexdigest()
    if key not in _WORDS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(tokenizer_file)
        tokenizer.encode_special_tokens = True
        _WORDS[key] = _Words(tokenizer)
    return _WORDS[key]


def pieces_of(
    docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """``(doc_id, piece int, start long, length long, ids_crc32 long, ids binary)``: the pieces of each document.

    A document is its ids by the tokenizer file (special tokens are plain text, none is added), then ``end_id``; null or
    empty text: ``end_id`` alone.  Only a document of more than ``capacity`` ids has several pieces, all but the last of
    ``capacity``.  ``ids`` are little-endian unsigned 32-bit integers, null unless asked for.  Repeated rows give
    repeated pieces, an empty table none; further columns are not read.

    Words are cut at ASCII white space first, so the tokenizer must drop it and must not look past it (word_bpe_49k).
    The file (a fixed vocabulary of a few MB) is read by the driver and broadcast; texts stay in their partitions.
    """
    with open(tokenizer_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    step = 4 * capacity

    def run(batches):
        words = _words_of(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, text in enumerate(some.column(1)):
                    if len(words) > MEMO:
                        words.turn()
                    raw = (text.as_py() or "").encode("utf-8")
                    ids = memoryview(b"".join(map(words.__getitem__, raw.split())) + end)
                    for k, cut in enumerate(range(0, len(ids), step)):
                        part = ids[cut : cut + step]
                        row.append(i)
                        piece.append(k)
                        start.append(cut // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        kept.append(bytes(part) if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    names,
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, doc_ids, offsets, ids binary)``: the token sequences themselves, from packed pieces that
    carry their ids.  A sequence holds its capacity at most, so a group is small whatever the corpus."""
    one = F.struct("offset", "doc_id", "length", "ids")
    rows = packed.where("sequence_id is not null").groupBy("sequence_id").agg(F.sort_array(F.collect_list(one)).alias("held"))
    return rows.select(
        "sequence_id",
        F.aggregate("held", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.col("held.doc_id").alias("doc_ids"),
        F.col("held.offset").alias("offsets"),
        F.aggregate("held", F.lit(b""), lambda n, x: F.concat(n, x["ids"])).alias("ids"),
    )
