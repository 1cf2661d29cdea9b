"""The index and its ranges against plain searching."""

import numpy as np
import pytest
from riskloom.llm import fmindex as X


def count(text, part):
    return sum(1 for i in range(len(text) - len(part) + 1) if list(text[i : i + len(part)]) == list(part))


@pytest.mark.parametrize("seed", range(6))
def test_backward_search(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(1, rng.choice([3, 4, 10]), 300), 0)
    index = X.FMIndex(text, 32)
    start = rng.integers(0, 280, 60)
    end = start + rng.integers(0, 20, 60)
    for s, e, got in zip(start, end, index.backward(text, start, end, 2)):
        want = e
        while want > s and count(text, text[want - 1 : e]) >= 2:
            want -= 1
        assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_ranges(seed):
    rng = np.random.default_rng(seed)
    pieces = [rng.integers(1, 40, rng.integers(3, 30)) for _ in range(12)]
    pieces += [np.concatenate([p[2:], rng.integers(1, 40, 5)]) for p in pieces[:6]]
    text = np.concatenate([np.append(p, 0) for p in pieces])
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    starts = ends - [len(p) for p in pieces]
    found = X.repeated_ranges(X.FMIndex(text, 64), text, starts, ends, 5)
    covered = {(i, w) for part in found for i, a, b in part for w in range(a, b - 4)}
    want = {(i, w) for i, (a, b) in enumerate(zip(starts, ends)) for w in range(a, b - 4) if count(text, text[w : w + 5]) >= 2}
    assert covered == want
