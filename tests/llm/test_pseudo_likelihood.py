"""The window network itself: gradients against differences, and scores against word frequencies on held-out text."""

import random
from collections import Counter
from math import log

import numpy as np
import pytest

from carelake.llm import pseudo_likelihood as L
from carelake.llm.common import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_step_follows_the_gradient(monkeypatch):
    monkeypatch.setattr(L, "HIDDEN", 5)
    rng = np.random.default_rng(7)
    w = {k: rng.normal(0, 0.3, v.shape) for k, v in L.start_weights(9).items()}
    ids = rng.integers(0, 9, 40)
    ctx = L.contexts(ids, 9)
    loss = lambda w: -L.log_probabilities(w, ctx, ids).mean()
    t = L.Trainer(w)
    start = {k: v.copy() for k, v in t.seen.items()}
    t.step(ctx, ids)
    for k, v in w.items():
        # Adagrad's sum has grown by the squared gradient, against which the weight has moved
        got = np.sign(v - t.w[k]) * np.sqrt(np.maximum(t.seen[k] - start[k], 0))
        for at in [tuple(rng.integers(0, n) for n in v.shape) for _ in range(25)]:
            moved = []
            for d in (1e-4, -1e-4):
                other = {n: x.copy() for n, x in w.items()}
                other[k][at] += d
                moved.append(loss(other))
            assert abs(got[at] - (moved[0] - moved[1]) / 2e-4) < 2e-4, (k, at)


def test_start_is_the_frequencies():
    n = np.arange(16) * 10
    w = L.start_weights(16, of_id=n)
    w["embed"] *= 0
    logs = L.log_probabilities(w, np.zeros((2 * L.SIDE, 16), np.int64), np.arange(16))
    assert np.allclose(np.exp(logs), (n + 0.5) / (n + 0.5).sum(), rtol=1e-4)


def test_held_out_text_beats_word_frequencies(spark):
    """Two vocabularies, a document of one of them: neighbours tell which, frequencies can't."""
    rnd = random.Random(1)
    vocabularies = [[f"{p}{i}" for i in range(60)] for p in "ab"]
    text = lambda k: " ".join(rnd.choices(vocabularies[k % 2], weights=range(60, 0, -1), k=120))
    train = [(i, text(i)) for i in range(400)]
    held_out = [(i, text(i)) for i in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    words, w = L.train(frame(train))
    counts = Counter(x for _, t in train for x in t.split())
    total = sum(counts.values())
    plain = np.mean([log(counts[x] / total) for _, t in held_out for x in t.split()])
    got = np.mean([r.mean_log_likelihood for r in L.score(frame(held_out), words, w).collect()])
    assert got > plain + 0.3


def test_weights_gather_with_the_words():
    """Shards times weights, which a round gathers, grow as the words do."""
    def gathered(total):
        own = max(L.OWN_LEAST, L.isqrt(total) // L.PER_OWN)
        return max(1, L.isqrt(total) // L.PER_SHARD) * own

    for total in (10**9, 10**11, 10**13):
        assert 0.8 < gathered(100 * total) / gathered(total) / 100 < 1.3


def _plain_gradients(w, ctx, ids):
    """Of the mean loss, one word at a time."""
    out = {k: np.zeros_like(v) for k, v in w.items()}
    for j, i in enumerate(ids):
        c, o = divmod(i, len(w["class_bias"]))
        h = np.tanh(sum(w["embed"][d, ctx[d, j]] for d in range(2 * L.SIDE)) + w["hidden"])
        p, q = np.exp(h @ w["classes"] + w["class_bias"]), np.exp(h @ w["words"][c] + w["word_bias"][c])
        p, q = p / p.sum(), q / q.sum()
        p[c] -= 1
        q[o] -= 1
        dh = (w["classes"] @ p + w["words"][c] @ q) * (1 - h * h)
        out["classes"] += np.outer(h, p)
        out["class_bias"] += p
        out["words"][c] += np.outer(h, q)
        out["word_bias"][c] += q
        out["hidden"] += dh
        for d in range(2 * L.SIDE):
            out["embed"][d, ctx[d, j]] += dh
    return {k: v / len(ids) for k, v in out.items()}


@pytest.mark.parametrize("used", [range(49), [0, 1, 6, 20, 48], [13]])
def test_step_is_that_of_the_words_one_by_one(used):
    """Classes with many words, one word and none."""
    rng = np.random.default_rng(4)
    w = {k: rng.normal(0, 0.3, v.shape) for k, v in L.start_weights(49).items()}
    texts = [rng.choice(list(used), n) for n in (1, 40, 0, 3)]
    ids, ctx = np.concatenate(texts), L.contexts_of(texts, 49)
    t = L.Trainer(w)
    t.step(ctx, ids)
    for k, g in _plain_gradients(w, ctx, ids).items():
        assert np.allclose(t.w[k], w[k] - L.RATE * g / np.sqrt(1e-3 + g * g), atol=1e-5), k
    assert t.words == 44


def test_step_has_no_softmax_of_its_own_for_each_class(monkeypatch):
    """The operations on words don't become more and smaller as classes become more."""
    softmax, calls = L._softmax, []
    monkeypatch.setattr(L, "_softmax", lambda a: calls.append(a.shape[1]) or softmax(a))
    for side in (4, 30):
        ids = np.random.default_rng(5).integers(0, side * side, 3000)
        calls.clear()
        L.Trainer(L.start_weights(side * side)).step(L.contexts(ids, side * side), ids)
        assert calls == [3000, 3000]


def test_contexts_of_texts_stay_apart():
    texts = [np.array(t, np.int64) for t in ([], [1, 2, 3], [4], [], [5, 6])]
    assert L.contexts_of(texts, 9).T.tolist() == [
        [9, 9, 2, 3], [9, 1, 3, 9], [1, 2, 9, 9], [9, 9, 9, 9], [9, 9, 6, 9], [9, 5, 9, 9]
    ]
    assert L.contexts_of([texts[0]], 9).shape == (2 * L.SIDE, 0)


def test_words_of_bytes_and_text():
    for t in (None, "", " \t\n", "Ab  cÄ\u00a0d\x0bE\U0001f600"):
        assert L.words_of(t) == L.words_of(None if t is None else t.encode())
    assert L.words_of("Ab  cÄ\u00a0d\x0bE") == ["ab".encode(), "cÄ\u00a0d".encode(), b"e"]
