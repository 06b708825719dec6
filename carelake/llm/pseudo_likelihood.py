"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words on both sides: embeddings of the two before and the two after it are summed, a tanh
layer follows, and a two-step softmax gives first the class, then the id in its class.  A document's score is the sum of
the conditional log-probabilities of its words.

Words are counted over the whole corpus.  The most frequent have ids of their own, as many as the square root of the
corpus's words commands; the number and the size of the classes follow.  The others share ids by hash, and such a word's
probability is that of its id times the word's share in the id (Witten-Bell: a part is left for words not in the corpus,
spread over byte strings by length).  So neighbours of a rare word bear on its id, counts on the word.  Counts of the more
frequent words go to the tasks, those of the others are joined in Spark.

Texts are coded once: a document becomes the codes of its words, which training and scoring read.

The network starts as the frequencies of the ids (its biases are their logarithms), so what it learns is what neighbours
add.  It is trained on every word of the corpus: documents are dealt to shards by row number, whatever the layout of the
table, a task runs stochastic gradient steps over its shard from the same start, and weights are averaged, by words seen,
in blocks.  Each round takes the documents of another hash class, so all rounds together take every document once.  The
shards are as many as the square root of the corpus's words commands, as are the weights, so what is gathered (shards times
weights) grows with the corpus and no faster.
"""

from __future__ import annotations

import zlib
from collections import Counter
from math import isqrt, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize, text_key

#: Words with ids of their own: at least OWN_LEAST, and one for each PER_OWN of the square root of the corpus's words.
OWN_LEAST, PER_OWN = 448, 8
#: Words without an id of their own whose counts the tasks hold; counts of the others are joined.
HELD = 200_000
SIDE, HIDDEN = 2, 16
ROUNDS, RATE = 2, 0.5
#: Words of a training step: half the square root of the corpus's words, between these.
STEP_LEAST, STEP = 256, 4096
#: Words in a matrix at once when scoring.
SCORE_STEP = 1 << 14
#: A round has one shard for each so many of the square root of the corpus's words.
PER_SHARD = 750
#: Weights in a block of the average.
BLOCK = 1 << 14
#: Words that are put together before they are cut into steps.
GATHER = 1 << 15
FLUSH = 200_000


def words_of(text: str | bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of anything but ASCII white space; of a text or its UTF-8."""
    text = text or b""
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


def _utf8(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.binary()).to_pylist()


class Words(NamedTuple):
    """The words of the corpus: those with ids of their own, by frequency, and their counts; counts of the next ones; ids in all (a square);
    of each shared id the words and the distinct words; and ``(word, n)`` of all words."""

    own: list[bytes]
    own_n: np.ndarray
    held: list[tuple[bytes, int]]
    size: int
    shared_n: np.ndarray
    shared_kinds: np.ndarray
    total: int
    counts: DataFrame | None

    def to_tasks(self) -> Words:
        return self._replace(counts=None)

    def of_id(self) -> np.ndarray:
        """Occurrences of each id."""
        return np.concatenate((self.own_n, np.zeros(self.size - len(self.own_n) - len(self.shared_n), np.int64), self.shared_n))


class Codes(dict):
    """Word -> code.  Words with an id of their own and held ones have a code of their own, the others that of their shared
    id, from ``unheld`` on.  By code: ``ids``, and ``share``, the log-probability of the word in its id; for unheld words it
    lacks the logarithm of the count."""

    def __init__(self, words: Words):
        super().__init__((w, i) for i, w in enumerate(words.own))
        own, held = len(words.own), words.held
        self.first, self.shared = words.size - len(words.shared_n), len(words.shared_n)
        self.update((w, own + i) for i, (w, _) in enumerate(held))
        self.unheld = self.most = own + len(held)
        self.most += FLUSH
        slots = np.array([zlib.crc32(w) % self.shared for w, _ in held], np.int64)
        base = -np.log(np.maximum(words.shared_n + words.shared_kinds, 1))
        self.ids = np.concatenate((np.arange(own), self.first + slots, np.arange(self.first, words.size)))
        self.share = np.concatenate((np.zeros(own), base[slots] + np.log(np.array([n for _, n in held], float)), base))
        self.left = np.log(np.maximum(words.shared_kinds, 1) * self.shared)

    def unseen(self, word: bytes) -> float:
        """In place of the logarithm of its count, for a word not in the corpus."""
        return self.left[zlib.crc32(word) % self.shared] - (len(word) + 1) * log(257)

    def __missing__(self, word: bytes) -> int:
        i = self.unheld + zlib.crc32(word) % self.shared
        if len(self) < self.most:
            self[word] = i
        return i


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all documents; counted in tasks before the shuffle."""

    def run(batches):
        c: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "n"]
            )
            c.clear()

        for b in batches:
            for t in _utf8(b.column(0)):
                c.update(words_of(t))
                if len(c) > FLUSH:
                    yield from out()
        yield from out()

    counts = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts, "words")


def _most_frequent(counts: DataFrame, own: int, held: int) -> list[tuple[bytes, int]]:
    """The ``own`` most frequent words (ties by word) and, after them, the next ones down to a count that keeps them
    within ``held``: a bound for the driver from a histogram of counts, an eighth of an octave wide."""
    level = F.floor(F.log2("n") * 8)
    levels = sorted(map(tuple, counts.groupBy(level.alias("l")).agg(F.count("*")).collect()), reverse=True)
    lowest, found = None, 0
    for at, n in levels:
        if found + n > own + held:
            break
        lowest, found = at, found + n
    if found < own:
        rows = counts.orderBy(F.col("n").desc(), "word").limit(own)
    else:
        rows = counts.where(level >= lowest) if lowest is not None else counts.limit(0)
    return sorted(((bytes(r["word"]), r["n"]) for r in rows.select("word", "n").collect()), key=lambda x: (-x[1], x[0]))


def corpus_words(docs: DataFrame) -> Words:
    counts = count_words(docs)
    total = counts.agg(F.sum("n")).first()[0] or 0
    own = max(OWN_LEAST, isqrt(total) // PER_OWN)
    side = isqrt(own + own // 7 - 1) + 1  # about one id in eight is shared
    shared = side * side - own
    top = _most_frequent(counts, own, HELD)
    of_id = counts.groupBy(F.pmod(F.crc32("word"), F.lit(shared)).alias("slot")).agg(F.sum("n"), F.count("*")).collect()
    n, kinds = np.zeros(shared, np.int64), np.zeros(shared, np.int64)
    for slot, words, distinct in of_id:
        n[slot], kinds[slot] = words, distinct
    for w, c in top[:own]:
        n[zlib.crc32(w) % shared] -= c
        kinds[zlib.crc32(w) % shared] -= 1
    own_n = np.array([c for _, c in top[:own]], np.int64)
    return Words([w for w, _ in top[:own]], own_n, top[own:], side * side, n, kinds, total, counts)


def start_weights(size: int, seed: int = 3, of_id: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Of ``size`` ids, and one more for an edge, in as many classes as a class has ids.  Given the occurrences of each
    id, biases are their logarithms."""
    r, side = np.random.default_rng(seed), isqrt(size)
    draw = lambda *s: r.normal(0, 0.1, s).astype(np.float32)
    counts = np.ones((side, side)) if of_id is None else of_id.reshape(side, side) + 0.5
    return {
        "embed": draw(2 * SIDE, size + 1, HIDDEN),
        "hidden": np.zeros(HIDDEN, np.float32),
        "classes": draw(HIDDEN, side),
        "class_bias": np.log(counts.sum(axis=1) / counts.sum()).astype(np.float32),
        "words": draw(side, HIDDEN, side),
        "word_bias": np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32),
    }


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float64)


def unflat(v: np.ndarray, size: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, a in sorted(start_weights(size).items()):
        out[k] = v[at : at + a.size].reshape(a.shape).astype(np.float32)
        at += a.size
    return out


def contexts(ids: np.ndarray, edge: int) -> np.ndarray:
    """For each word of a text the ids of its neighbours, SIDE on either side (edges have an id of their own)."""
    return contexts_of([ids], edge)


def contexts_of(texts: list[np.ndarray], edge: int) -> np.ndarray:
    """:func:`contexts` of the words of several texts, one after the other."""
    gap, sizes = np.full(SIDE, edge), [len(t) for t in texts]
    padded = np.concatenate([gap, *(x for t in texts for x in (t, gap))])
    at = np.arange(sum(sizes)) + np.repeat(np.arange(1, len(texts) + 1) * SIDE, sizes)
    return np.stack([np.take(padded, at + d) for d in (*range(-SIDE, 0), *range(1, SIDE + 1))])


def _softmax(a):
    """Of columns, in place; columns are short and rows long, which keeps each operation one run through memory."""
    a -= a.max(axis=0)
    np.exp(a, out=a)
    a /= a.sum(axis=0)
    return a


def _log_softmax_at(a, row):
    """Of each column the log-probability of the given row."""
    a -= a.max(axis=0)
    out = a[row, np.arange(a.shape[1])]
    np.exp(a, out=a)
    return out - np.log(a.sum(axis=0))


def _hidden(w, ctx):
    h = np.take(w["embed"][0], ctx[0], axis=0, mode="clip")
    for d in range(1, 2 * SIDE):
        h += np.take(w["embed"][d], ctx[d], axis=0, mode="clip")
    h += w["hidden"]
    return np.tanh(h, out=h)


def _by_class(cls: np.ndarray):
    """Yields (class, places of its words)."""
    order = np.argsort(cls.astype(np.uint16), kind="stable")
    ends = np.cumsum(np.bincount(cls))
    for c, (s, e) in enumerate(zip([0, *ends], ends)):
        if s < e:
            yield c, order[s:e]


def log_probabilities(w: dict[str, np.ndarray], ctx: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Conditional log-probability of each id."""
    h = _hidden(w, ctx)
    cls, of = np.divmod(ids, len(w["class_bias"]))
    out = _log_softmax_at(w["classes"].T @ h.T + w["class_bias"][:, None], cls)
    for c, some in _by_class(cls):
        a = w["words"][c].T @ np.take(h, some, axis=0).T + w["word_bias"][c][:, None]
        out[some] += _log_softmax_at(a, of[some])
    return out


class Trainer:
    """Adagrad steps on blocks of words."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = {k: v.copy() for k, v in w.items()}
        self.seen = {k: np.full_like(v, 1e-3) for k, v in w.items()}
        self.words = 0

    def _push(self, k, g):
        self.seen[k] += g * g
        self.w[k] -= RATE * g / np.sqrt(self.seen[k])

    def _push_rows(self, d, met, g):
        """Of the embeddings at the place ``d``, the rows met."""
        seen = np.take(self.seen["embed"][d], met, axis=0)
        seen += g * g
        self.seen["embed"][d][met] = seen
        self.w["embed"][d][met] -= RATE * g / np.sqrt(seen)

    def step(self, ctx: np.ndarray, ids: np.ndarray) -> None:
        """Values at words have a row for each hidden unit, and a row of ones for the bias, so that sums over words run through
        memory; words are put in order of their class, whose softmaxes then are one operation on all of them."""
        w, n = self.w, len(ids)
        self.words += n
        h = _hidden(w, ctx)
        h = np.concatenate((h.T, np.ones((1, n), h.dtype)))
        cls, of = np.divmod(ids, len(w["class_bias"]))
        p = _softmax(np.concatenate((w["classes"], w["class_bias"][None])).T @ h)
        p[cls, np.arange(n)] -= 1
        dh = w["classes"] @ p
        g = h @ p.T / n
        push = {"classes": g[:-1], "class_bias": g[-1]}

        parts = list(_by_class(cls))
        order = np.concatenate([some for _, some in parts])
        ends = np.cumsum([len(some) for _, some in parts])
        spans = [(c, slice(e - len(some), e)) for (c, some), e in zip(parts, ends)]
        weights = np.concatenate((w["words"], w["word_bias"][:, None]), axis=1)
        by_class, q = np.take(h, order, axis=1), np.empty((weights.shape[2], n), p.dtype)
        for c, at in spans:
            np.matmul(weights[c].T, by_class[:, at], out=q[:, at])
        _softmax(q)
        q[of[order], np.arange(n)] -= 1
        back, g = np.empty_like(dh), np.zeros_like(weights)
        for c, at in spans:
            np.matmul(w["words"][c], q[:, at], out=back[:, at])
            np.matmul(by_class[:, at], q[:, at].T, out=g[c])
        g /= n
        push |= {"words": g[:, :-1], "word_bias": g[:, -1]}

        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        dh += np.take(back, place, axis=1)
        dh *= 1 - h[:-1] * h[:-1]
        push["hidden"] = dh.sum(1) / n
        for k, g in push.items():
            self._push(k, g)
        dh = dh.astype(np.float64)
        row = np.empty(w["embed"].shape[1], np.int64)
        for d in range(2 * SIDE):
            met = np.flatnonzero(np.bincount(ctx[d]))
            row[met] = np.arange(len(met))
            at = row[ctx[d]]
            g = np.stack([np.bincount(at, x) for x in dh], axis=1) / n
            self._push_rows(d, met, g.astype(np.float32))


CODED = "row long, n_words long, codes binary, rare array<struct<word: binary, times: long, unseen: double>>"


def code(docs: DataFrame, words: Words) -> DataFrame:
    """``(doc_id, row, n_words, codes, rare)``, written: each document as the codes of its words (packed 32-bit integers),
    and its words whose counts the tasks don't hold."""
    shared = docs.sparkSession.sparkContext.broadcast(words.to_tasks())

    def run(batches):
        codes = Codes(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                packed, sizes, unheld = [], [], []
                for t in _utf8(some.column(2)):
                    found = words_of(t)
                    one = np.fromiter(map(codes.__getitem__, found), np.int32, len(found))
                    packed.append(one.tobytes())
                    sizes.append(len(one))
                    unheld.append(Counter([found[j] for j in np.flatnonzero(one >= codes.unheld).tolist()]))
                rare = pa.StructArray.from_arrays(
                    [
                        pa.array([x for c in unheld for x in c], pa.binary()),
                        pa.array([x for c in unheld for x in c.values()], pa.int64()),
                        pa.array([codes.unseen(x) for c in unheld for x in c], pa.float64()),
                    ],
                    ["word", "times", "unseen"],
                )
                ends = pa.array(np.cumsum([0, *map(len, unheld)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        some.column(1),
                        pa.array(sizes, pa.int64()),
                        pa.array(packed, pa.binary()),
                        pa.ListArray.from_arrays(ends, rare),
                    ],
                    ["doc_id", "row", "n_words", "codes", "rare"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return materialize(rows.mapInArrow(run, f"doc_id {kind}, {CODED}"), "coded")


def _blocks(batches, most: int):
    """Of batches with codes last: lists of (batch, row, codes) of about ``most`` words or one text, in order."""
    held, size = [], 0
    for b in batches:
        for i, x in enumerate(b.column(b.num_columns - 1)):
            held.append((b, i, np.frombuffer(x.as_py(), np.int32)))
            size += len(held[-1][2])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def train_on(coded: DataFrame, words: Words, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The weights, from all documents of a coded table."""
    sc, w = coded.sparkSession.sparkContext, start_weights(words.size, of_id=words.of_id())
    ids_of, edge = Codes(words.to_tasks()).ids, words.size
    shards = max(1, isqrt(words.total) // PER_SHARD)
    step = min(STEP, max(STEP_LEAST, isqrt(words.total) // 2))
    for r in range(rounds):
        shared = sc.broadcast((ids_of, w))

        def run(batches, shared=shared):
            ids, trainer = shared.value[0], Trainer(shared.value[1])
            for held in _blocks(batches, GATHER):
                full = [ids[one] for _, _, one in held if len(one)]
                if not full:
                    continue
                ctx, all_ids = contexts_of(full, edge), np.concatenate(full)
                for i in range(0, len(all_ids), step):
                    trainer.step(ctx[:, i : i + step], all_ids[i : i + step])
            if trainer.words:
                v = flat(trainer.w).astype("<f4")
                parts = [v[i : i + BLOCK].tobytes() for i in range(0, len(v), BLOCK)]
                n = np.full(len(parts), trainer.words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.binary()), pa.array(n)],
                    ["block", "v", "n"],
                )

        def average(part: pa.Table) -> pa.Table:
            total, n = 0.0, 0
            for x, words_seen in zip(part["v"], part["n"].to_pylist()):
                total = total + np.frombuffer(x.as_py(), "<f4").astype(np.float64) * words_seen
                n += words_seen
            return pa.table({"block": part["block"][:1], "v": pa.array([(total / n).astype("<f4").tobytes()], pa.binary())})

        dealt = coded.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == r).select("row", "codes").repartition(shards, "row")
        sums = dealt.select("codes").mapInArrow(run, "block int, v binary, n long")
        got = sums.groupBy("block").applyInArrow(average, "block int, v binary").orderBy("block").collect()
        if got:  # the weights themselves: some 90 for each id
            w = unflat(np.frombuffer(b"".join(bytes(x["v"]) for x in got), "<f4"), words.size)
    return w


def train(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Words, dict[str, np.ndarray]]:
    """The corpus's words and the weights, from all documents of ``docs(doc_id, text)``."""
    words = corpus_words(docs)
    return words, train_on(code(docs, words), words, rounds)


def score(docs: DataFrame, words: Words, w: dict[str, np.ndarray]) -> DataFrame:
    """``(doc_id, n_words, log_likelihood, mean_log_likelihood)`` of every row, over its whole text.

    Null, empty and blank texts have no word: sum 0 and no mean.  Repeated rows give repeated rows, an empty table none.
    """
    return score_coded(code(docs, words), words, w)


def score_coded(rows: DataFrame, words: Words, w: dict[str, np.ndarray]) -> DataFrame:
    """:func:`score` of a coded table."""
    codes = Codes(words.to_tasks())
    shared = rows.sparkSession.sparkContext.broadcast((codes.ids, codes.share, w))
    edge = words.size

    def run(batches):
        ids, share, weights = shared.value
        for held in _blocks(batches, GATHER):
            sizes = np.array([len(one) for _, _, one in held])
            total = np.zeros(len(held))
            all_codes = np.concatenate([one for _, _, one in held])
            if len(all_codes):
                all_ids = ids[all_codes]
                ctx = contexts_of([ids[one] for _, _, one in held], edge)
                logs = np.concatenate(
                    [
                        log_probabilities(weights, ctx[:, i : i + SCORE_STEP], all_ids[i : i + SCORE_STEP])
                        for i in range(0, len(all_ids), SCORE_STEP)
                    ]
                ).astype(np.float64)
                total = np.bincount(np.repeat(np.arange(len(held)), sizes), logs + share[all_codes], len(held))
            columns = [pa.array([b.column(k)[i].as_py() for b, i, _ in held], held[0][0].column(k).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes), pa.array(total)], ["row", "doc_id", "n_words", "part"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    known = rows.select("row", "doc_id", "codes").mapInArrow(run, f"row long, doc_id {kind}, n_words long, part double")
    # unheld words lack the logarithm of the count, or, where not in the corpus, that of the part left for them
    counted = words.counts.select("word", F.log("n").alias("log_n"))
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(counted, "word", "left")
    rare = rare.select(
        "row",
        F.lit(None).cast(kind).alias("doc_id"),
        F.lit(None).cast("long").alias("n_words"),
        (F.col("times") * F.coalesce("log_n", "unseen")).alias("part"),
    )
    summed = known.unionByName(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("part").alias("log_likelihood")
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return summed.select("doc_id", "n_words", "log_likelihood", mean.alias("mean_log_likelihood"))
