"""Language of a text by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary.  For each language, probabilities of pieces are fitted by expectation
maximisation on the words of that language: a forward and a backward pass over all ways to cut a word into pieces give
the expected count of each piece.  A text's score in a language is the product over its words of the summed probability
of all their segmentations (forward pass); the answer is the language of the largest, with its posterior.

Words are counted by language first, so passes run over distinct words; only piece counts (pieces x languages) reach the
driver.  Inside a task, words of one length form a matrix, and each pass is a few array operations for each place.  A run
of letters is passed over whole, however long: sums are scaled as they go, so none runs out of range.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Rounds of expectation maximisation.
ROUNDS = 3
#: Places between two scalings of the sums, and places times words in a matrix.
SCALED, CELLS = 16, 1 << 16
#: Probability of a letter that no piece covers, and count added to each piece.
UNKNOWN, SMOOTH = 1e-7, 0.05
#: Distinct words a worker remembers.
MEMO = 400_000
#: Distinct words counted together before they are passed on.
FLUSH = 200_000
_START = "▁"

_runs = regex.compile(r"[\p{L}\p{M}]+").findall
_latin_runs = re.compile(r"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+").findall
_beyond_latin = re.compile(r"[^\x00-\u024f\u2000-\u206f\u20ac]").search


def vocabulary(model_path: str) -> list[str]:
    """Lower-case pieces of letters and their marks (with or without the word-start mark) of a sentencepiece model, by
    code point."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    whole = regex.compile(r"[\p{L}\p{M}]+").fullmatch
    return sorted(p for p in pieces if whole(p.removeprefix(_START)))


def letters(text: str) -> list[str]:
    """Runs of letters and combining marks of the lower-cased text that hold a letter."""
    low = text.lower()
    if not _beyond_latin(low):  # the same runs: no marks there, and letters are a short list
        return _latin_runs(low)
    return [w for w in _runs(low) if w.isalpha() or any(map(str.isalpha, w))]


class Lattice:
    """All prefixes of the pieces as 64-bit hashes by length, to follow the pieces in many words at once.  (Two strings
    of one hash would share a probability; at 64 bits that is not seen in practice.)"""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        prefixes: dict[int, dict[str, int]] = {}
        for i, p in enumerate(pieces):
            for m in range(1, len(p) + 1):
                prefixes.setdefault(m, {}).setdefault(p[:m], -1)
            prefixes[len(p)][p] = i
        self.by_length = []
        for m in sorted(prefixes):
            codes = self.codes(list(prefixes[m]))
            h = np.zeros(len(codes), np.uint64)
            for j in range(m):
                h = self._extend(h, codes[:, j])
            order = np.argsort(h)
            self.by_length.append((h[order], np.array(list(prefixes[m].values()))[order]))

    @staticmethod
    def codes(words: list[str]) -> np.ndarray:
        """Code points of words of one length, a row for each."""
        return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)

    @staticmethod
    def _extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def arcs(self, codes: np.ndarray, start: int):
        """Pieces that start at a place: yields (end, rows of the words, piece of each)."""
        rows, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for m, (hashes, ids) in enumerate(self.by_length[: codes.shape[1] - start]):
            h = self._extend(h, codes[rows, start + m])
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            alive = hashes[at] == h
            rows, h, at = rows[alive], h[alive], at[alive]
            if not len(rows):
                return
            found = ids[at]
            whole = found >= 0
            if whole.any():
                yield start + m + 1, rows[whole], found[whole]

    def forward(self, words: list[str], p: np.ndarray, keep: list | None = None, scales: list | None = None) -> np.ndarray:
        """alpha[place][word, language]: summed probability of all segmentations up to a place.

        With ``scales``, sums are divided by their own size at every SCALED-th place; it gets a row for each place: the
        logarithms of what its sums were divided by in all.
        """
        codes = self.codes(words)
        n = codes.shape[1]
        alpha = np.zeros((n + 1, len(words), p.shape[1]))
        alpha[0] = 1.0
        reach, divided = len(self.by_length), np.zeros(alpha.shape[1:])
        for s in range(n):
            if scales is not None:
                if s % SCALED == 0 and s:
                    divided = divided + np.log(alpha[s])
                    alpha[s : s + reach + 1] /= alpha[s].copy()
                scales.append(divided)
            alpha[s + 1] += alpha[s] * UNKNOWN  # the letter that no piece covers
            for e, rows, ids in self.arcs(codes, s):
                alpha[e][rows] += alpha[s][rows] * p[ids]
                if keep is not None:
                    keep.append((s, e, rows, ids))
        if scales is not None:
            scales.append(divided)
        return alpha

    def log_total(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Of words of one length, the logarithm of the probability summed over all segmentations, by language."""
        scales: list = []
        last = self.forward(words, p, scales=scales)[-1]
        return np.log(last) + scales[-1]

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected count of each piece in words of one length and one language (p: one column)."""
        arcs: list = []
        scales: list = []
        alpha = self.forward(words, p, arcs, scales)[:, :, 0]
        n, reach = len(words[0]), len(self.by_length)
        total = np.log(alpha[n]) + scales[n][:, 0]
        beta, divided = np.zeros_like(alpha), np.zeros(len(words))
        beta[n] = 1.0
        out = np.zeros(self.size)
        by_start: dict[int, list] = {}
        for s, *arc in arcs:
            by_start.setdefault(s, []).append(arc)
        for s in range(n - 1, -1, -1):
            beta[s] += beta[s + 1] * UNKNOWN
            weight = counts * alpha[s] * np.exp(scales[s][:, 0] + divided - total)
            for e, rows, ids in by_start.get(s, ()):
                through = p[ids, 0] * beta[e][rows]
                beta[s][rows] += through
                out += np.bincount(ids, through * weight[rows], self.size)
            if s % SCALED == 0 and s:
                divided = divided + np.log(beta[s])
                beta[s : s + reach + 1] /= beta[s].copy()
        return out


def _by_length(words):
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return groups


def _portions(members: list[int], size: int):
    """Words of one length in matrices of some CELLS places."""
    most = max(1, CELLS // (size + 2))
    for i in range(0, len(members), most):
        yield members[i : i + most]


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)`` over all documents of ``docs(lang, text)`` with both; counted in tasks before the shuffle."""

    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                    ["lang", "word", "n"],
                )
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                held.setdefault(lang, Counter()).update(letters(text.as_py()))
                if sum(map(len, held.values())) > FLUSH:
                    yield from out()
        yield from out()

    counted = docs.select("lang", "text").where("lang is not null and text is not null")
    return counted.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, pieces: list[str], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages in order and the matrix of piece probabilities (pieces x languages), from ``docs(lang, text)``."""
    words = materialize(word_counts(docs), "words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())  # one row for each language
    at = {x: i for i, x in enumerate(langs)}
    p = np.full((len(pieces), len(langs)), 1.0 / max(1, len(pieces)))
    sc = docs.sparkSession.sparkContext
    for _ in range(rounds if langs else 0):
        shared = sc.broadcast((pieces, p))

        def run(batches, shared=shared):
            lattice, probs = Lattice(shared.value[0]), shared.value[1]
            total = np.zeros_like(probs)
            for b in batches:
                lang, found, n = (b.column(k).to_pylist() for k in range(3))
                groups: dict = {}
                for i, w in enumerate(found):
                    groups.setdefault((at[lang[i]], len(w)), []).append(i)
                for (j, size), members in groups.items():
                    for ids in _portions(members, size):
                        weights = np.array([n[i] for i in ids], float)
                        marked = [_START + found[i] for i in ids]
                        total[:, j] += lattice.expected(marked, weights, probs[:, j : j + 1])
            piece, j = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[piece, j])],
                ["piece", "lang", "n"],
            )

        sums = words.select("lang", "word", "n").mapInArrow(run, "piece int, lang int, n double")
        p = np.full((len(pieces), len(langs)), SMOOTH)
        for r in sums.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():  # at most pieces x languages
            p[r["piece"], r["lang"]] += r["n"]
        p /= p.sum(axis=0)
    return langs, p


class _Scores(dict):
    """Word -> row of its log-probabilities; filled for the words of a batch at once, emptied when full."""

    def __init__(self, lattice: Lattice, p: np.ndarray):
        self.lattice, self.p = lattice, p
        self.rows = np.zeros((0, p.shape[1]))

    def learn(self, runs: set[str]) -> None:
        new = [w for w in runs if w not in self]
        if not new:
            return
        if len(self) + len(new) > MEMO:
            self.clear()
            self.rows = np.zeros((0, self.p.shape[1]))
            new = list(runs)
        logs = np.zeros((len(new), self.p.shape[1]))
        for size, members in _by_length(new).items():
            for ids in _portions(members, size):
                logs[ids] = self.lattice.log_total([_START + new[i] for i in ids], self.p)
        base = len(self.rows)
        self.rows = np.concatenate((self.rows, logs))
        self.update(zip(new, range(base, base + len(new))))


def predict(docs: DataFrame, pieces: list[str], langs: list[str], p: np.ndarray) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row: the likeliest language and its posterior among those learned.

    ``und`` with score 0 if the text is null or has no letter, or no language was learned.  Repeated rows give repeated
    rows, an empty table none; whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pieces, p))

    def run(batches):
        scores = _Scores(Lattice(shared.value[0]), shared.value[1]) if langs else None
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [letters(t.as_py() or "") for t in part.column(1)]
                if scores is not None:
                    scores.learn(set().union(*texts))
                names, values = [], []
                for words in texts:
                    if scores is None or not words:
                        names.append("und")
                        values.append(0.0)
                        continue
                    ids = np.fromiter(map(scores.__getitem__, words), np.int64, len(words))
                    total = scores.rows[ids].sum(axis=0)
                    best = int(total.argmax())
                    names.append(langs[best])
                    values.append(float(1.0 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(values, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
