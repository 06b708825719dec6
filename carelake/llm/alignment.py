"""Alignment of two tokenisers over the same bytes, by merge-path partitioning.

The token ends of A and of B, over many documents in a row, are two sorted lists.  Diagonals of their merge grid, one every
``WORK`` ends, are crossed with the merge path by binary search, which divides the merge into pieces of equal work however
long the documents are.  Pieces are independent: each steps through its own ends and emits the overlaps of A and B tokens,
with a note where both end.  Groups (runs of tokens up to a common end) are numbered in each piece, and numbers are carried
over the pieces' edges to stitch groups that cross them.

Corpus-wide, an id pair counts the documents that link it.  Documents are taken in chunks of bounded size; a chunk asks for
each of its distinct pairs once, whatever the number of documents and links that hold it, and gets the counts back by place.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Ends in a piece of the merge.
WORK = 256
#: Bytes of text that are aligned at once, and links that a chunk gathers before it is closed.
BATCH_BYTES, CHUNK_LINKS = 1 << 21, 1 << 21
#: Pairs of a chunk's request in one row.
ASK = 1 << 14
#: Links of a group that are listed one by one; of a larger group, distinct ids are paired with their multiplicity.
LISTED = 1 << 12


# ------------------------------------------------------------------ merge path
def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first ``d`` of the merged ends are from ``a`` (on a tie a's end is first), for each diagonal d."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        first = np.zeros(len(mid), bool)
        first[open_] = a[mid[open_]] <= b[diagonals[open_] - 1 - mid[open_]]
        low = np.where(open_ & first, mid + 1, low)
        high = np.where(open_ & ~first, mid, high)
    return low


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(a token, b token, both end, overlaps of each piece)``: the overlaps in order, for rising ends with one last end.

    All pieces take their n-th step at once.  An end of b that equals an end of a adds no overlap: it was noted there.
    """
    total = len(a) + len(b)
    edges = np.append(np.arange(0, total, work), total)
    cut = merge_path(a, b, edges)
    i, j = cut[:-1].copy(), (edges - cut)[:-1]
    size = np.diff(edges)
    pieces = len(size)
    got_a, got_b = np.zeros((pieces, work), np.int64), np.zeros((pieces, work), np.int64)
    emits, both = np.zeros((pieces, work), bool), np.zeros((pieces, work), bool)
    a_, b_ = np.append(a, np.iinfo(np.int64).max), np.append(b, np.iinfo(np.int64).max)
    for step in range(work if total else 0):
        live = step < size
        end_a, end_b = a_[i], b_[j]
        from_a = end_a <= end_b
        got_a[:, step], got_b[:, step] = i, j
        both[:, step] = live & (end_a == end_b)
        # where b's end equals a's, the step before this one, in this piece or the last, has noted both
        emits[:, step] = live & (from_a | (a_[i - 1] != end_b) | (i == 0))
        i, j = i + (live & from_a), j + (live & ~from_a)
    return got_a[emits], got_b[emits], both[emits], emits.sum(axis=1)


def stitch(a_token, b_token, both, held) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each a token and each b token.  Numbers start from 0 in each piece; a piece goes on in the group
    that the pieces before it left open, which is the number of groups that they closed."""
    starts = np.cumsum(held) - held
    closed = np.cumsum(both) - both
    inside = closed - np.repeat(closed[np.minimum(starts, max(len(both) - 1, 0))], held) if len(both) else closed
    done = np.add.reduceat(np.append(both, False).astype(np.int64), starts) * (held > 0) if len(held) else held
    group = np.repeat(np.cumsum(done) - done, held) + inside
    last_a = np.flatnonzero(np.append(a_token[1:] != a_token[:-1], True)) if len(a_token) else []
    last_b = np.flatnonzero(np.append(b_token[1:] != b_token[:-1], True)) if len(b_token) else []
    return group[last_a], group[last_b]


# ------------------------------------------------------------------ tokenisers
class ByteLevel:
    """Tokeniser A: byte-level BPE from a tokenizers file, run on a space and the text.

    Given the same vocabulary as ranks, texts of Latin letters and common marks go through the faster library (equal ids);
    other texts go through the file's own, since libraries may know different versions of Unicode's classes."""

    _OTHER = re.compile(r"[^\x00-\u036f\u2000-\u206f\u20a0-\u20bf]").search

    def __init__(self, file: bytes, ranks: bytes | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_buffer(file)
        self.slow.encode_special_tokens = True
        self.fast = None
        if ranks is not None:
            import tiktoken

            table = {base64.b64decode(x): int(y) for x, y in map(bytes.split, ranks.splitlines())}
            self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        sign = {c: b for b, c in enumerate(_byte_signs())}
        self.bytes_of = [b""] * self.slow.get_vocab_size()
        for token, i in self.slow.get_vocab().items():
            try:
                self.bytes_of[i] = bytes(sign[c] for c in token)
            except KeyError:  # an added token, not byte-level
                self.bytes_of[i] = token.encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [
            self.fast.encode_ordinary(" " + t)
            if self.fast is not None and not self._OTHER(t)
            else self.slow.encode(" " + t, add_special_tokens=False).ids
            for t in texts
        ]


def _byte_signs() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else the next one
    from U+0100 on."""
    out, extra = [], 256
    for b in range(256):
        prints = 33 <= b <= 126 or 161 <= b <= 172 or b >= 174
        out.append(chr(b if prints else extra))
        extra += not prints
    return out


class Pieces:
    """Tokeniser B: pieces with byte fallback; the library itself puts a space before the text."""

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode()
            for i, x in enumerate(names)
        ]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


_PAIRS: dict[str, Aligner] = {}


# ------------------------------------------------------------------ alignment of a batch
@dataclass
class Aligned:
    """A batch of documents: their figures, the text form of their groups, and their distinct links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes | None]
    doc: np.ndarray  # document, pair and occurrences of each distinct link, by document and pair
    pair: np.ndarray
    times: np.ndarray


class Aligner:
    """Two tokenisers: an object each with ``ids(texts)`` and ``bytes_of`` (the bytes of each id)."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.len_a = np.array([len(x) for x in a.bytes_of], np.int64)
        self.len_b = np.array([len(x) for x in b.bytes_of], np.int64)
        self.base = len(b.bytes_of)
        self.signs = [str(i).encode() + s for s, n in ((b",", a), (b"|", a), (b",", b), (b";", b)) for i in range(len(n.bytes_of))]

    def _encode(self, texts: list[str | None]):
        """Ids of both by document; none where a text is empty or the bytes of either don't give it back."""
        some = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in some]
        out_a, out_b = [[]] * len(texts), [[]] * len(texts)
        for i, t, x, y in zip(some, given, self.a.ids(given), self.b.ids(given)):
            raw = b" " + t.encode("utf-8", "surrogatepass")
            if b"".join(map(self.a.bytes_of.__getitem__, x)) == raw == b"".join(map(self.b.bytes_of.__getitem__, y)):
                out_a[i], out_b[i] = x, y
        return out_a, out_b

    def align(self, texts: list[str | None], work: int = WORK) -> Aligned:
        ids_a, ids_b = self._encode(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        group_a, group_b = stitch(*overlaps(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]), work))
        doc_a = np.repeat(np.arange(len(texts)), n_a)
        count = int(group_a[-1]) + 1 if len(group_a) else 0
        in_a, in_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        end_a, end_b = np.cumsum(in_a), np.cumsum(in_b)
        doc_of = doc_a[end_a - 1] if count else np.zeros(0, np.int64)
        n_groups = np.bincount(doc_of, minlength=len(texts))
        links = np.r_[0, np.cumsum(in_a * in_b)]
        ends = np.cumsum(n_groups)
        n_links = links[ends] - links[ends - n_groups]
        doc, pair, times = self._links(a, b, in_a, in_b, end_a, end_b, doc_of)
        return Aligned(n_a, n_b, n_groups, n_links, self._text(a, b, group_a, group_b, end_a, end_b, n_a, n_b), doc, pair, times)

    def _text(self, a, b, group_a, group_b, end_a, end_b, n_a, n_b) -> list[bytes | None]:
        """``a1,a2|b1;a3|b2,b3`` by document, None without tokens."""
        na, nb = len(self.a.bytes_of), len(self.b.bytes_of)
        signs = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        signs[at_a + np.r_[0, end_b][group_a]] = a + na * (at_a + 1 == end_a[group_a])
        signs[at_b + end_a[group_b]] = b + 2 * na + nb * (at_b + 1 == end_b[group_b])
        signs, out, at = signs.tolist(), [], 0
        for n in (n_a + n_b).tolist():
            out.append(b"".join(map(self.signs.__getitem__, signs[at : at + n]))[:-1] if n else None)
            at += n
        return out

    def _links(self, a, b, in_a, in_b, end_a, end_b, doc_of):
        """Distinct (document, pair) with occurrences; a pair is a's id * ids of B + b's id."""
        large = np.flatnonzero(in_a * in_b > LISTED)
        held = in_b.copy()
        held[large] = 0
        group_a = np.repeat(np.arange(len(in_a)), in_a)
        fan = held[group_a]
        first = np.repeat((end_b - in_b)[group_a], fan)
        b_at = first + np.arange(len(first)) - np.repeat(np.cumsum(fan) - fan, fan)
        span = len(self.a.bytes_of) * self.base
        keys = [np.repeat(doc_of[group_a] * span + a * self.base, fan) + b[b_at]]
        counts = [np.ones(len(keys[0]), np.int64)]
        for g in large.tolist():
            ids_a, x = np.unique(a[end_a[g] - in_a[g] : end_a[g]], return_counts=True)
            ids_b, y = np.unique(b[end_b[g] - in_b[g] : end_b[g]], return_counts=True)
            keys.append((doc_of[g] * span + ids_a[:, None] * self.base + ids_b[None, :]).ravel())
            counts.append((x[:, None] * y[None, :]).ravel())
        if len(keys) == 1:
            key, times = np.unique(keys[0], return_counts=True)
        else:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            times = np.zeros(len(key), np.int64)
            np.add.at(times, at, np.concatenate(counts))
        return key // span, key % span, times


# ------------------------------------------------------------------ over a table
@dataclass
class _Files:
    """What a worker builds its tokenisers from."""

    a: bytes
    b: bytes
    ranks: bytes | None
    pattern: str | None

    def aligner(self) -> Aligner:
        key = hashlib.sha256(b"/".join([self.a, self.b, self.ranks or b"", (self.pattern or "").encode()])).hexdigest()
        if key not in _PAIRS:
            _PAIRS[key] = Aligner(ByteLevel(self.a, self.ranks, self.pattern), Pieces(self.b))
        return _PAIRS[key]


def _read(path: str | None) -> bytes | None:
    if path is None:
        return None
    with open(path, "rb") as f:
        return f.read()


def _narrow(x: np.ndarray) -> bytes:
    top = int(x.max(initial=0))
    return x.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if top >> 8 * w == 0)).tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    *,
    ranks_a: str | None = None,
    pattern_a: str | None = None,
    with_groups: bool = False,
) -> DataFrame:
    """The written first step, documents and requests in one table.

    Rows with ``codes`` null are documents: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups`` (text form, null
    unless asked for), and their distinct links as places in their chunk's request (``at``, packed 32-bit integers) with occurrences
    (``times``, packed integers as wide as the largest needs).  Other rows are requests: ``codes`` are pairs of the chunk from place ``first`` on, ``docs`` how many
    of its documents hold each.  A chunk closes after CHUNK_LINKS links, at the end of a batch.
    """
    files = docs.sparkSession.sparkContext.broadcast(_Files(_read(path_a), _read(path_b), _read(ranks_a), pattern_a))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups binary, chunk long, "
        "at binary, times binary, first int, codes array<long>, docs array<int>"
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        aligner = files.value.aligner()
        names, kinds = ["doc_id", *_FIGURES, "groups_sha256", "groups", "chunk", "at", "times", "first", "codes", "docs"], None
        held: list[tuple[pa.Array, Aligned]] = []
        chunk, links = TaskContext.get().partitionId() << 33, 0

        def close():
            nonlocal chunk
            pairs = np.concatenate([x.pair for _, x in held])
            codes, at = np.unique(pairs, return_inverse=True)
            docs_of = np.bincount(at, minlength=len(codes))
            start = 0
            for ids, x in held:
                n = len(ids)
                cut = np.searchsorted(x.doc, np.arange(n + 1))
                mine = at[start : start + len(x.pair)].astype("<u4").tobytes()
                start += len(x.pair)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        *[pa.array(getattr(x, f)) for f in _FIGURES],
                        pa.array(["" if g is None else hashlib.sha256(g).hexdigest() for g in x.groups], pa.string()),
                        pa.array(x.groups if with_groups else [None] * n, pa.binary()),
                        pa.array(np.full(n, chunk)),
                        pa.array([mine[4 * p : 4 * q] for p, q in zip(cut, cut[1:])], pa.binary()),
                        pa.array([_narrow(x.times[p:q]) for p, q in zip(cut, cut[1:])], pa.binary()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.list_(pa.int64())),
                        pa.nulls(n, pa.list_(pa.int32())),
                    ],
                    names,
                )
            for p in range(0, len(codes), ASK):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(1, kinds),
                        *[pa.nulls(1, pa.int64())] * 4,
                        pa.nulls(1, pa.string()),
                        pa.nulls(1, pa.binary()),
                        pa.array([chunk], pa.int64()),
                        pa.nulls(1, pa.binary()),
                        pa.nulls(1, pa.binary()),
                        pa.array([p], pa.int32()),
                        pa.array([codes[p : p + ASK]], pa.list_(pa.int64())),
                        pa.array([docs_of[p : p + ASK]], pa.list_(pa.int32())),
                    ],
                    names,
                )
            chunk += 1

        for ids, texts in _by_size(batches):
            kinds = ids.type
            held.append((ids, aligner.align(texts)))
            links += len(held[-1][1].pair)
            if links >= CHUNK_LINKS:
                yield from close()
                held, links = [], 0
        if held:
            yield from close()

    return materialize(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema), "aligned")


def _by_size(batches) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Rows in batches of some BATCH_BYTES of text; a longer text is one of its own."""
    for b in batches:
        start, size, texts = 0, 0, []
        for i, t in enumerate(b.column(1)):
            t = t.as_py()
            texts.append(t)
            size += len(t or "") + 16
            if size >= BATCH_BYTES:
                yield b.column(0).slice(start, len(texts)), texts
                start, size, texts = i + 1, 0, []
        if texts:
            yield b.column(0).slice(start, len(texts)), texts


def requests(aligned: DataFrame) -> DataFrame:
    """``(asker, place, pair, docs)``: distinct pairs of each chunk, and how many of its documents hold them."""
    one = F.posexplode(F.arrays_zip("codes", "docs")).alias("k", "x")
    return aligned.where("codes is not null").select("chunk", "first", one).select(
        F.col("chunk").alias("asker"), (F.col("first") + F.col("k")).alias("place"), F.col("x.codes").alias("pair"), F.col("x.docs").alias("docs")
    )


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``(pair, docs long, best boolean)``: documents of the corpus that link a pair (a's id * n_b + b's id), and whether
    no pair of the same A id has more."""
    counts = materialize(requests(aligned).groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs")
    a_id = F.expr(f"pair div {int(n_b)}").alias("a_id")
    most = counts.groupBy(a_id).agg(F.max("docs").alias("most"))
    return counts.withColumn("a_id", a_id).join(most, "a_id").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def link_figures(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups)``, a row for each document.

    The counts that a chunk asked for meet its documents by chunk, which bounds what a task holds at once.
    """
    asked = requests(aligned).select("asker", "place", "pair")
    replies = asked.join(counts, "pair").select("asker", "place", "docs", "best")
    given = ["doc_id", *_FIGURES, "groups_sha256", "groups"]
    documents = aligned.where("codes is null").select(*given, "chunk", "at", "times")
    kind = aligned.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
        "groups binary"
    )

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right["place"].to_numpy()
        docs, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        docs[place], best[place] = right["docs"].to_numpy(), right["best"].to_numpy()
        packed = left["at"].to_pylist()
        at = np.frombuffer(b"".join(packed), "<u4")
        sizes = [len(x) // 4 for x in packed]
        times = np.concatenate([np.zeros(0, np.int64), *map(_wide, left["times"].to_pylist(), sizes)])
        ends = np.cumsum(sizes)
        total = lambda x: np.diff(np.r_[0, np.r_[0, np.cumsum(x)][ends]])
        figures = {"n_best": total(times * best[at]), "count_sum": total(times * docs[at])}
        return pa.table(
            [left["doc_id"], *[left[c] for c in _FIGURES], *map(pa.array, figures.values()), left["groups_sha256"], left["groups"]],
            names=["doc_id", *_FIGURES, *figures, "groups_sha256", "groups"],
        )

    return documents.groupBy("chunk").cogroup(replies.groupBy("asker")).applyInArrow(evaluate, schema)


def align(docs: DataFrame, path_a: str, path_b: str, **kw) -> DataFrame:
    """Alignment figures of every document by two tokeniser files (byte-level A, pieces B); see :func:`link_figures`.

    Null and empty texts, and texts that the bytes of either tokeniser don't give back, have no tokens: zeros, and an
    empty ``groups_sha256``.  Repeated rows are documents each and count so.  Empty table: no rows.  Further columns are
    not read.  Keywords are those of :func:`align_documents`.
    """
    aligned = align_documents(docs, path_a, path_b, **kw)
    n_b = len(Pieces(_read(path_b)).bytes_of)
    return link_figures(aligned, materialize(pair_counts(aligned, n_b), "counts"))
