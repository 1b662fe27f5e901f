"""Probabilities of the language model add up to one over all words, none of them drawn."""

import numpy as np
import pytest

from tidemark.llm import lm


@pytest.mark.parametrize("axes", [4, 12])
def test_probabilities_of_all_words_sum_to_one(spark, monkeypatch, axes):
    monkeypatch.setattr(lm, "AXES", axes)
    rng = np.random.default_rng(3)
    size, own = 3000, 200
    r, q = (rng.normal(0, 0.7, (size, lm.WIDTH + 1)).astype(np.float16) for _ in range(2))
    q[-1, :-1] *= 6  # one word of the tail that some contexts all but ask for
    r_file, q_file = lm.ship(spark, r), lm.ship(spark, q)
    uni = rng.gamma(0.3, 10, size) + 0.5
    g_file, c_file = lm.normalised(spark, r_file, q_file, uni, own)
    tables = [lm.shipped(f) for f in (r_file, q_file, g_file, c_file)]
    assert len(tables[2]) == (own + 16 if axes == 4 else size)
    full = r[:, :-1].astype(np.float64) @ q[:, :-1].astype(np.float64).T + q[:, -1]
    for context in (0, own - 1, own, 777, size - 1):
        p = lm.log_probability(np.full(size, context), np.arange(size), own, *tables)
        assert abs(np.exp(p.astype(np.float64)).sum() - 1) < 1e-4
        if context < own or axes == 12:  # a context that has a group to itself
            want = full[context] - full[context].max()
            assert np.allclose(p, want - np.log(np.exp(want).sum()), atol=2e-4)
