"""Quality score by a generalised additive model with pairwise interactions.

Measures of a text are cut into bins.  Cyclic boosting goes round the measures; at each, a shallow tree over its bins fits
the gradient and is added to the measure's lookup table.  Pairs of measures that explain most of what is left get tables
over two coarse binnings in the same way.  A score is the sigmoid of the intercept and the sum of table entries.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import WORD_RE
from carelake.llm.quality_rules import repeated_words

#: Labelled rows the model is fitted on at most: those of the smallest hashed doc_id.
MAX_LABELLED = 20_000
BINS, COARSE = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 8
RATE, LEAST = 0.2, 5.0

FEATURES = (
    "words", "word_length", "upper", "symbols", "marks", "digits", "short_words", "distinct_words",
    "dup_lines", "repeated", "line_length", "shouts", "bars", "spaces", "entropy", "long_words",
)

_words = re.compile(WORD_RE).findall


def features(text: str | None) -> list[float]:
    """The measures of one text, whatever its length (null: empty)."""
    text = text or ""
    words = _words(text)
    n, size = max(1, len(words)), max(1, len(text))
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    c = np.bincount(raw, minlength=256)
    upper, digits = int(c[65:91].sum()), int(c[48:58].sum())
    symbols = int(c[[35, 36, 37, 38, 42]].sum())
    marks = int(c[[33, 44, 46, 58, 59, 63]].sum())
    lines = text.split("\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    share = c[c > 0] / max(1, len(raw))
    return [
        float(np.log1p(len(words))),
        float(lengths.mean()),
        upper / size,
        symbols / size,
        marks / n,
        digits / size,
        float((lengths <= 3).sum()) / n,
        len(set(words)) / n,
        1 - len(set(lines)) / len(lines),
        repeated_words(words) / n,
        float(np.log1p(size / len(lines))),
        int(c[33]) / n,
        int(c[124]) / n,
        int(c[32]) / size,
        float(-(share * np.log2(share)).sum()) if len(share) else 0.0,
        float((lengths >= 12).sum()) / n,
    ]


class Model:
    """Bins, tables, pair tables and intercept; plain arrays, some kilobytes."""

    def __init__(self):
        self.edges: list[np.ndarray] = []
        self.tables = np.zeros((0, BINS))
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables = np.zeros((0, COARSE, COARSE))
        self.intercept = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def coarse(self, b: np.ndarray) -> np.ndarray:
        return b * COARSE // BINS

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.intercept)
        for j in range(len(self.tables)):
            out += self.tables[j][b[:, j]]
        c = self.coarse(b)
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[c[:, i], c[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.full(len(x), 1 / (1 + np.exp(-self.intercept)))
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Of a row of bins: gain and place of the best cut."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + LEAST) + gr**2 / (hr + LEAST) - g.sum() ** 2 / (h.sum() + LEAST)
    at = int(gain.argmax()) if len(gain) else 0
    return (float(gain[at]) if len(gain) else 0.0), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values by bin of a tree of that depth over one row of bins."""
    if depth and len(g) > 1:
        gain, at = _best_cut(g, h)
        if gain > 1e-9:
            return np.concatenate((_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)))
    return np.full(len(g), g.sum() / (h.sum() + LEAST))


def _plane_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree over two binnings: the better first cut, then the best cut of each side."""
    best = (-1.0, g)
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        _, at = _best_cut(a.sum(1), b.sum(1))
        out, total = np.zeros_like(a), 0.0
        for rows in (slice(0, at), slice(at, None)):
            gg, hh = a[rows].sum(0), b[rows].sum(0)
            out[rows] = _tree(gg, hh, 1)
            gain, _ = _best_cut(gg, hh)
            total += gain + gg.sum() ** 2 / (hh.sum() + LEAST)
        if total > best[0]:
            best = (total, out.T if turn else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on rows of features and labels 0 or 1."""
    m = Model()
    rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    m.intercept = float(np.log(rate / (1 - rate)))
    if len(y) < 2 or y.min() == y.max():
        return m
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    m.edges = [np.quantile(x[:, j], cuts) for j in range(x.shape[1])]
    b = m.bins(x)
    m.tables = np.zeros((x.shape[1], BINS))
    f = np.full(len(y), m.intercept)

    def push():
        p = 1 / (1 + np.exp(-f))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(x.shape[1]):
            g, h = push()
            step = RATE * _tree(np.bincount(b[:, j], g, BINS), np.bincount(b[:, j], h, BINS), 2)
            m.tables[j] += step
            f += step[b[:, j]]
    c = m.coarse(b)
    flat = lambda i, j: c[:, i] * COARSE + c[:, j]
    plane = lambda at, v: np.bincount(at, v, COARSE * COARSE).reshape(COARSE, COARSE)
    g, h = push()
    gains = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            at = flat(i, j)
            gains.append((-_plane_tree(plane(at, g), plane(at, h))[0], i, j))
    m.pairs = [(i, j) for _, i, j in sorted(gains)[:PAIRS]]
    m.pair_tables = np.zeros((len(m.pairs), COARSE, COARSE))
    places = [flat(i, j) for i, j in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, at in enumerate(places):
            g, h = push()
            step = RATE * _plane_tree(plane(at, g), plane(at, h))[1]
            m.pair_tables[k] += step
            f += step.ravel()[at]
    return m


def _featured(rows: DataFrame, kinds: str) -> DataFrame:
    """``rows`` (its last column the text) with the text replaced by its features."""

    def run(batches):
        for b in batches:
            got = [features(t.as_py()) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(got, pa.list_(pa.float64()))], [*b.schema.names[:-1], "x"]
            )

    return rows.mapInArrow(run, f"{kinds}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model:
    """Fit on the rows of ``docs(doc_id, text)`` with a label in ``labels(doc_id, quality)``: at most ``most`` rows, those
    of the smallest hashed doc_id.  Rows without label take no part; a doc_id with several labels gives a row for each."""
    known = docs.select("doc_id").distinct()
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("y"))
        .where("doc_id is not null and y in (0, 1)")
        .join(known, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")  # most rows
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = _featured(rows, f"doc_id {kind}, y int").orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(most)
    got = found.orderBy("doc_id", "y", "x").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row, from the text alone.  Null and empty texts get the score of an empty
    text; repeated rows give repeated rows, an empty table none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            s = m.score(np.array([features(t.as_py()) for t in b.column(1)], float))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
