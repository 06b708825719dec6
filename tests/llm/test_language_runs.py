"""Whole runs: segmentations are summed over runs of any length, and marks are part of them."""

from math import log

import numpy as np
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from carelake.llm import language_id as L

PIECES = sorted({"▁", "▁a", "a", "b", "ab", "ba", "▁ab", "abb", "क", "का", "ि", "▁कि", "é", "́"})
P = np.stack([np.linspace(0.02, 0.2, len(PIECES)), np.linspace(0.2, 0.01, len(PIECES))], axis=1)


def log_sum(word, p):
    """By places from the end, in Python integers' friend: logarithms."""
    prob = dict(zip(PIECES, p))
    longest = max(map(len, PIECES))
    out = [0.0] * (len(word) + 1)
    for s in range(len(word) - 1, -1, -1):
        terms = [log(L.UNKNOWN) + out[s + 1]]
        terms += [log(prob[word[s:e]]) + out[e] for e in range(s + 1, min(len(word), s + longest) + 1) if word[s:e] in prob]
        top = max(terms)
        out[s] = top + log(sum(np.exp(t - top) for t in terms))
    return out[0]


def test_forward_over_long_runs_and_marks():
    lattice = L.Lattice(PIECES)
    for word in ("abba" * 15, "ab" * 400, "z" * 90, "किका" * 20, "aéb" * 30, "a"):
        got = lattice.log_total([L._START + word, L._START + word[::-1]], P)
        want = [[log_sum(L._START + w, P[:, k]) for k in range(2)] for w in (word, word[::-1])]
        assert np.allclose(got, want, rtol=1e-9), word


def test_expected_counts_of_long_runs():
    """Expected counts are p * d log Z / d p, also where the sums themselves are far below the smallest number."""
    lattice, words = L.Lattice(PIECES), [L._START + "abbab" * 60, L._START + "aabbz" * 60]
    counts = np.array([2.0, 3.0])
    p = P[:, :1]
    got = lattice.expected(words, counts, p)
    assert counts @ lattice.log_total(words, p)[:, 0] < -745  # no double holds the product
    for i in range(len(PIECES)):
        slope = 0.0
        for d in (1e-6, -1e-6):
            moved = p.copy()
            moved[i] *= 1 + d
            slope += np.sign(d) * (counts @ lattice.log_total(words, moved)[:, 0]) / 2e-6
        assert abs(got[i] - slope) < 1e-3 * max(1, abs(slope)), PIECES[i]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aÉßıªº×÷²½ ́िक9_-’€")), max_size=25))
def test_runs_are_letters_and_marks(text):
    want = [w for w in regex.findall(r"[\p{L}\p{M}]+", text.lower()) if any(map(str.isalpha, w))]
    assert L.letters(text) == want


def test_long_runs_are_not_cut():
    assert L.letters("x" * 1000) == ["x" * 1000] and L.letters("किताब") == ["किताब"]
    assert L.letters("été") == ["été"] and L.letters("́ ि") == []
