"""Words longer than the arrays that short ones share: the same sums, whole."""

import numpy as np
import pytest

from voxloom.llm import language_id as lid

VOCAB = ["▁", "▁a", "▁ab", "a", "b", "ab", "ba", "abab", "▁q", "c", "bab"]


def model():
    rng = np.random.default_rng(0)
    m = lid.fit_counts({"x": {"▁abab": 3, "▁bab": 1}, "y": {"▁cab": 2, "▁aaa": 5}}, VOCAB)
    m.prob = rng.dirichlet(np.ones(len(m.prob)), 2).T
    return m


def forward(m, word):
    """Plain sums over all segmentations."""
    row = {p: i for i, p in enumerate(VOCAB)}
    alpha = [np.ones(2)]
    for j in range(1, len(word) + 1):
        alpha.append(sum(alpha[i] * m.prob[row.get(word[i:j], len(VOCAB))] for i in range(max(0, j - 5), j) if word[i:j] in row or i == j - 1))
    return np.log(alpha[-1])


@pytest.mark.parametrize("n", [39, 40, 41, 42, 60])
def test_both_sides_of_the_border(n):
    m = model()
    words = ["▁" + ("abc" * n)[:n], "▁" + ("abqab" * n)[:n]]
    assert np.allclose(m.log_prob(words), [forward(m, w) for w in words])
    assert lid.letter_runs(words[0][1:]) == [words[0]]


def test_expected_counts_of_long_words(monkeypatch):
    m = model()
    words, weight = ["▁" + "abab" * 9, "▁" + "cabba" * 7], np.array([[2.0, 1.0], [0.0, 3.0]])
    short = m.expected(words, weight)
    monkeypatch.setattr(lid, "LONGEST", 3)
    assert np.allclose(m.expected(words, weight), short) and np.allclose(m.log_prob(words), [forward(m, w) for w in words])


def test_a_very_long_run_scores():
    m = model()
    got = lid.Scorer(m).score(["ab" * 20_000, "é" * 5000])
    assert all(x in ("x", "y") and 0 <= s <= 1 for x, s in got)
