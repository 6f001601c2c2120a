"""Monotonic paths against all paths."""

from itertools import combinations

import numpy as np
import pytest

from lectern.functions.udfs import monotonic


@pytest.mark.parametrize("seed", range(40))
def test_monotonic_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    frames = int(rng.integers(1, 8))
    symbols = int(rng.integers(1, frames + 1))
    scores = rng.normal(size=(frames, symbols))
    paths = [np.cumsum([t in moves for t in range(frames)]) for moves in combinations(range(1, frames), symbols - 1)]
    best = max(paths, key=lambda p: scores[np.arange(frames), p].sum())
    assert monotonic(scores).tolist() == best.tolist()


def test_monotonic_without_a_path():
    assert monotonic(np.zeros((2, 3))).tolist() == [] and monotonic(np.zeros((3, 0))).tolist() == []
