"""Personal data: exact patterns, and spans that a character model adds.

The model reads characters in classes with a bidirectional LSTM and a CRF over tags (outside, begin and inside of each
kind), trained in numpy on windows labelled by the patterns (all digits are one class, so none is learned by heart) and on
copies of these whose spans are changed so that the patterns miss them: no plus, other marks, at and dot spelled or set
apart, two numbers side by side.  Where something like a span is in a window and the patterns don't find it, the window is
no example, so the model isn't taught that it is none.

A text is cut into overlapping windows; each is decoded by itself, and a character takes its tag from the window that holds
it nearest its middle, so spans that cross a border come out whole.  Spans of every kind hold a digit, an at sign or a dot
that is spelled or in brackets, so a window with none of these isn't run.
"""

from __future__ import annotations

import random
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
#: Window and step in characters.
WIDTH, STEP = 96, 48
#: Bounds of the sample the model is trained on: windows with spans of each kind, and with digits but no span.
MAX_SPANNED, MAX_OTHER = 600, 600
#: Copies with changed spans of each window with a whole span.
COPIES = 2
HIDDEN, STEPS, BATCH, LEARN = 16, 500, 64, 0.01
#: Least mean posterior of the tags of a span that the model adds.
SURE = 0.9

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}").finditer
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_digits = re.compile(r"[^0-9]+")
_trigger = re.compile(r"[0-9@]")
_digit = re.compile(r"[0-9]{2}").fullmatch
_hint = re.compile(r"[0-9@]|\b[Dd][Oo][Tt]\b|[\[(]\.[\])]")
_spelled = re.compile(r"\b(?:(at)|dot)\b", re.I)
#: What may be a span: an at sign, at and dot spelled or in brackets, seven digits or more that marks set apart.
_maybe = re.compile(
    r"@|\bat\b.{1,40}?(?:\bdot\b|[\[(]\.[\])])"
    r"|(?<![0-9A-Za-z_])[0-9](?:(?:[\x20().\[\]/-]{1,3}|\x20?\bdot\b\x20?)?[0-9]){6,}(?![0-9A-Za-z_])",
    re.I,
)
_date = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2[0-9]{4})(?![0-9])")
_address = re.compile(r".+(?:@.+|\bat\b.*(?:\bdot\b|\.).+)", re.I | re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, leftmost and non-overlapping by kind, failing matches dropped; by start, then
    kind.  Each pattern is matched in time linear in the text (an address is found from its at sign)."""
    if not _trigger.search(text):
        return []
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end:
            run = text[end:at]
            start = end + len(run.rstrip(_LOCAL))
            m = _domain(text, at + 1) if start < at else None
            if m:
                out.append(("email", start, m.end()))
                end = m.end()
            else:
                end = at + 1
        at = text.find("@", at + 1)
    out += [("ip", m.start(), m.end()) for m in _ip(text) if all(len(x.lstrip("0")) < 4 and int(x[-4:]) < 256 for x in m[0].split("."))]
    for m in _card(text):
        digits = _digits.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _phone(text):
        if 10 <= len(_digits.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# characters by class: 0 none, digits 1, vowels 2, other small letters 3, capitals 4, other letters 5, white space 6,
# each of these marks its own, the words at and dot their own, other 7
_MARKS = "@.+-()_%:/#$&*,!|"
N_CLASSES = 10 + len(_MARKS)
N_TAGS = 1 + 2 * len(KINDS)


def _table() -> np.ndarray:
    t = np.full(0x250, 7, np.int8)
    for c in range(0x250):
        s = chr(c)
        if "0" <= s <= "9":
            t[c] = 1
        elif s in _MARKS:
            t[c] = 8 + _MARKS.index(s)
        elif s.isspace():
            t[c] = 6
        elif s in "aeiou":
            t[c] = 2
        elif "a" <= s <= "z":
            t[c] = 3
        elif "A" <= s <= "Z":
            t[c] = 4
        elif s.isalpha():
            t[c] = 5
    return t


_CLASS = _table()


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(code < len(_CLASS), _CLASS[np.minimum(code, len(_CLASS) - 1)], 5)
    for m in _spelled.finditer(text):
        out[m.start() : m.end()] = N_CLASSES - 2 if m[1] else N_CLASSES - 1
    return out


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class Tagger:
    """Bidirectional LSTM with a CRF.  Weights: for each direction a table of input gates by class, recurrent weights;
    then emissions, their bias and the transitions."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {"emit": r.normal(0, 0.2, (2 * h, N_TAGS)), "bias": np.zeros(N_TAGS), "move": np.zeros((N_TAGS, N_TAGS))}
        for d in "fb":
            self.w[f"in_{d}"] = r.normal(0, 0.3, (N_CLASSES, 4 * h))
            self.w[f"in_{d}"][:, h : 2 * h] += 1.0  # remember at first
            self.w[f"rec_{d}"] = r.normal(0, 0.2, (h, 4 * h))

    def _run(self, x, d, keep=None):
        """x: windows x width, classes, in reading order of this direction."""
        n, width = x.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        table, rec = self.w[f"in_{d}"], self.w[f"rec_{d}"]
        out = np.empty((width, n, HIDDEN))
        for t in range(width):
            a = table[x[:, t]] + h @ rec
            i, f, o = (_sigmoid(a[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(a[:, 3 * HIDDEN :])
            before, old = c, h
            c = f * c + i * g
            s = np.tanh(c)
            h = o * s
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, g, before, s, old))
        return out

    def emissions(self, x, keep_f=None, keep_b=None):
        both = np.concatenate((self._run(x, "f", keep_f), self._run(x[:, ::-1], "b", keep_b)[::-1]), axis=2)
        return both @ self.w["emit"] + self.w["bias"], both

    def marginals(self, e):
        """Posterior of each tag, of each pair of neighbouring tags summed over places, for emissions width x n x tags."""
        move = self.w["move"]
        width, n, k = e.shape
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, width):
            m = a[t - 1].max(axis=1, keepdims=True)
            a[t] = e[t] + m + np.log(np.exp(a[t - 1] - m) @ np.exp(move) + 1e-300)
        for t in range(width - 2, -1, -1):
            v = b[t + 1] + e[t + 1]
            m = v.max(axis=1, keepdims=True)
            b[t] = m + np.log(np.exp(v - m) @ np.exp(move).T + 1e-300)
        z = a + b
        top = z.max(axis=2, keepdims=True)
        p = np.exp(z - top)
        total = top + np.log(p.sum(axis=2, keepdims=True))
        return np.exp(z - total), a, b, total[0, :, 0]

    def viterbi(self, e):
        move = self.w["move"]
        width, n, k = e.shape
        s, back = e[0], np.zeros((width, n, k), np.int64)
        for t in range(1, width):
            v = s[:, :, None] + move
            back[t] = v.argmax(axis=1)
            s = v.max(axis=1) + e[t]
        tags = np.empty((n, width), np.int64)
        tags[:, -1] = s.argmax(axis=1)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags

    def _back(self, x, d, kept, dh_out, grad):
        n, width = x.shape
        dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        rec = self.w[f"rec_{d}"]
        for t in range(width - 1, -1, -1):
            i, f, o, g, before, s, old = kept[t]
            dh = dh + dh_out[t]
            dc = dc + dh * o * (1 - s * s)
            da = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)), 1)
            hot = np.zeros((N_CLASSES, n))
            hot[x[:, t], np.arange(n)] = 1.0
            grad[f"in_{d}"] += hot @ da
            grad[f"rec_{d}"] += old.T @ da
            dh, dc = da @ rec.T, dc * f

    def gradient(self, x, y):
        """Mean gradient of the negative log-likelihood of tags y."""
        kf, kb = [], []
        e, both = self.emissions(x, kf, kb)
        p, a, b, total = self.marginals(e)
        width, n, k = e.shape
        grad = {name: np.zeros_like(v) for name, v in self.w.items()}
        de = p.copy()
        de[np.arange(width)[:, None], np.arange(n), y.T] -= 1.0
        for t in range(1, width):
            joint = np.einsum("ni,nj->ij", np.exp(a[t - 1] - total[:, None] * 0.5), np.exp(b[t] + e[t] - total[:, None] * 0.5))
            grad["move"] += joint * np.exp(self.w["move"])
            np.add.at(grad["move"], (y[:, t - 1], y[:, t]), -1.0)
        grad["emit"] += np.einsum("tnh,tnk->hk", both, de)
        grad["bias"] += de.sum(axis=(0, 1))
        dh = de @ self.w["emit"].T
        self._back(x, "f", kf, dh[:, :, :HIDDEN], grad)
        self._back(x[:, ::-1], "b", kb, dh[::-1, :, HIDDEN:], grad)
        return {name: v / n for name, v in grad.items()}

    def fit(self, x, y, steps: int = STEPS):
        """Adam steps over shuffled batches, as many at any sample size."""
        r = np.random.default_rng(5)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if not len(order):
                order = r.permutation(len(x))
            some, order = order[:BATCH], order[BATCH:]
            for k, g in self.gradient(x[some], y[some]).items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                self.w[k] -= LEARN * m[k] / (1 - 0.9**step) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)
        return self


def windows(text: str) -> list[int]:
    """Starts of the overlapping windows of a text that hold a digit, an at sign or a dot that is spelled or in brackets."""
    hits = [m.start() for m in _hint.finditer(text)]
    out: list[int] = []
    for at in hits:
        first = max(0, (at - WIDTH) // STEP + 1)
        for w in range(max(first, out[-1] + 1 if out else 0), at // STEP + 1):
            out.append(w)
    return [w * STEP for w in out]


def _matrix(codes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate((codes, np.zeros(WIDTH, codes.dtype)))
    return np.stack([padded[s : s + WIDTH] for s in starts]).astype(np.int64)


def model_spans(texts: list[str], tagger: Tagger | None) -> list[list[tuple[str, int, int]]]:
    """Spans of the model in each text, windows of all texts run together in blocks."""
    out: list[list] = [[] for _ in texts]
    if tagger is None:
        return out
    block, of = [], []

    def flush():
        if not block:
            return
        x = np.concatenate([b for _, b in block])
        e, _ = tagger.emissions(x)
        tags, sure = tagger.viterbi(e), tagger.marginals(e)[0]
        best = np.take_along_axis(sure.transpose(1, 0, 2), tags[:, :, None], 2)[:, :, 0]
        row = 0
        for (i, starts), (_, b) in zip(of, block):
            out[i] = _reconcile(texts[i], starts, tags[row : row + len(b)], best[row : row + len(b)])
            row += len(b)
        block.clear()
        of.clear()

    n = 0
    for i, text in enumerate(texts):
        starts = windows(text)
        if starts:
            block.append((i, _matrix(classes(text), starts)))
            of.append((i, starts))
            n += len(starts)
        if n > 2048:
            flush()
            n = 0
    flush()
    return out


def _reconcile(text, starts, tags, sure):
    """Spans of a text from the tags of its windows: a character's tag is that of the window whose middle is nearest."""
    place = np.concatenate([np.arange(s, s + WIDTH) for s in starts])
    far = np.abs(np.tile(np.arange(WIDTH), len(starts)) - (WIDTH - 1) / 2)
    order = np.lexsort((far, place))
    place, tag, p = place[order], tags.ravel()[order], sure.ravel()[order]
    first = np.concatenate(([True], place[1:] != place[:-1])) & (place < len(text))
    place, tag, p = place[first], tag[first], p[first]
    kind = np.where(tag > 0, (tag + 1) // 2, 0)
    cut = np.ones(len(place) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (place[1:] != place[:-1] + 1) | (tag[1:] % 2 == 1) & (tag[1:] > 0)
    edges = np.flatnonzero(cut)
    spans = []
    for s, e in zip(edges[:-1], edges[1:]):
        start, end = int(place[s]), int(place[e - 1]) + 1
        if not kind[s] or p[s:e].mean() < SURE or _digit(text[max(start - 1, 0) : start + 1]) or _digit(text[end - 1 : end + 1]):
            continue
        if _plausible(KINDS[kind[s] - 1], text[start:end]):
            spans.append((KINDS[kind[s] - 1], start, end))
    return spans


def _plausible(kind: str, span: str) -> bool:
    """What any span of the kind has: an address an at and something after it, a card its check digit, the others enough
    digits."""
    if kind == "email":
        return bool(_address.fullmatch(span))
    digits = _digits.sub("", span)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else len(digits) >= {"ip": 4, "phone": 7}[kind]


def all_spans(text: str, added: list[tuple[str, int, int]]) -> tuple[list, list]:
    """The base spans, and these with the model's that overlap none of them, in order."""
    base = base_spans(text)
    extra = [s for s in added if not any(s[1] < b[2] and b[1] < s[2] for b in base)] if added else []
    return base, sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0])))


def _tags(spans, start: int) -> list[int]:
    y = [0] * WIDTH
    for kind, s, e in spans:
        for i in range(max(s, start), min(e, start + WIDTH)):
            if not y[i - start]:
                y[i - start] = 2 * KINDS.index(kind) + (1 if i == s else 2)
    return y


def _unclear(text: str, spans) -> list[tuple[int, int]]:
    """Places of what may be a span and overlaps none of the spans; dates and, next to letters, digits are none."""
    got = [(m.start(), m.end()) for m in _maybe.finditer(_date.sub(lambda m: "x" * len(m[0]), text))]
    return [g for g in got if not any(g[0] < e and s < g[1] for _, s, e in spans)]


def _changed(kind: str, span: str, r: random.Random) -> list[tuple[str, str]]:
    """The span in a form that the patterns miss, as (text, kind or "") in order."""
    if kind == "email":
        at, dot = r.choice([" at ", " (at) ", "[at]", "(at)", " @ ", " AT "]), r.choice([" dot ", " (dot) ", "[dot]", "[.]", "(dot)", " DOT "])
        local, _, domain = span.partition("@")
        if r.random() < 0.6:  # names and hosts of other shapes
            local = local[: r.randint(min(3, len(local)), len(local))].rstrip("0123456789._%+-") or local
        if r.random() < 0.6:
            domain = re.sub("[0-9]", "", domain) if r.random() < 0.5 else domain
            domain = ".".join(domain.split(".")[-2:])
        return [((local.replace(".", dot) if r.random() < 0.3 else local) + at + domain.replace(".", dot), kind)]
    if kind == "ip":
        return [(span.replace(".", r.choice([" . ", "[.]", "(.)", " dot ", " dot "])), kind)]
    d = _digits.sub("", span)
    if kind == "phone":
        land, a, b, c, mark = d[:-10], d[-10:-7], d[-7:-4], d[-4:], r.choice("-. -")
        forms = [f"{b}{mark}{c}", f"({a}) {b}{mark}{c}", mark.join((a, b, c)), f"({a}){b}-{c}", f"{a} {b}{c}"]
        if land:
            forms += [mark.join((land, a, b, c)), f"{land} ({a}) {b}{mark}{c}", f"00{land} {a} {b} {c}"]
        return [(r.choice(forms), kind)]
    groups = lambda x, mark: mark.join(x[i : i + 4] for i in range(0, len(x), 4))
    if r.random() < 0.3:
        return [(groups(d, r.choice([".", " - ", "/"])), kind)]
    other = "".join(r.choice("0123456789") for _ in d)
    two, mark = [d, other] if r.random() < 0.5 else [other, d], r.choice(["", "", "", " ", "-"])
    return [(groups(two[0], mark), kind), (r.choice([" ", " ", "-"]), ""), (groups(two[1], mark), kind)]


def changed_copy(piece: str, y: list[int], r: random.Random) -> tuple[str, list[int]] | None:
    """The piece, tags along, with its whole spans in forms that the patterns miss; None if it has none."""
    text, tags, at, any_whole = "", [], 0, False
    while at < len(piece):
        end = at + 1
        if y[at] % 2:
            while end < len(piece) and y[end] == y[at] + 1:
                end += 1
        if y[at] % 2 and end < WIDTH:
            any_whole = True
            for part, kind in _changed(KINDS[y[at] // 2], piece[at:end], r):
                text += part
                tags += [y[at], *[y[at] + 1] * (len(part) - 1)] if kind else [0] * len(part)
        else:
            text += piece[at:end]
            tags += y[at:end]
        at = end
    return (text[:WIDTH], (tags + [0] * WIDTH)[:WIDTH]) if any_whole else None


def train(docs: DataFrame, spanned: int = MAX_SPANNED, other: int = MAX_OTHER) -> Tagger | None:
    """Train on windows of ``docs(text)`` labelled by the patterns: of each kind the ``spanned`` of smallest hash, and
    ``other`` with digits but no span, none that hold something unclear; and on copies with changed spans.  None if no
    window has a span."""

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(0):
                text = t.as_py() or ""
                if not (starts := windows(text)):
                    continue
                spans = base_spans(text)
                unclear = _unclear(text, spans)
                for s in starts:
                    if any(u < s + WIDTH and v > s for u, v in unclear):
                        continue
                    inside = [x for x in spans if x[1] < s + WIDTH and x[2] > s]
                    out.append((text[s : s + WIDTH], inside[0][0] if inside else "", _tags(inside, s)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.string()),
                    pa.array([x[2] for x in out], pa.list_(pa.int32())),
                ],
                ["piece", "kind", "y"],
            )

    found = docs.select("text").mapInArrow(run, "piece string, kind string, y array<int>")
    found = materialize(found.groupBy("piece").agg(F.min(F.struct("kind", "y")).alias("a")).select("piece", "a.*"), "windows")
    parts = [
        found.where(F.col("kind") == k).orderBy(F.xxhash64("piece"), "piece").limit(other if k == "" else spanned)
        for k in ("", *KINDS)
    ]
    got = reduce(DataFrame.unionAll, parts).toPandas().sort_values("piece")  # at most 4 * spanned + other rows
    if not (got["kind"] != "").any():
        return None
    pieces = [(p, [int(t) for t in y]) for p, y in zip(got["piece"], got["y"])]
    copies = [changed_copy(p, y, random.Random(f"{i} {p}")) for p, y in pieces for i in range(COPIES)]
    pieces += [c for c in copies if c]
    x = np.concatenate([_matrix(classes(p), [0]) for p, _ in pieces])
    return Tagger().fit(x, np.array([y for _, y in pieces], np.int64))


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``(doc_id, base, spans)`` of every row: arrays of (kind, start, end) in code points, by start, then kind.

    ``base`` are the patterns' spans, ``spans`` these and what the model adds.  Null or empty text: none.  Repeated rows
    give repeated rows, an empty table none; whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    named = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [t.as_py() or "" for t in part.column(1)]
                got = [all_spans(t, m) for t, m in zip(texts, model_spans(texts, shared.value))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([named(g[i]) for g in got], span) for i in (0, 1))], ["doc_id", "base", "spans"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    one = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base {one}, spans {one}")
