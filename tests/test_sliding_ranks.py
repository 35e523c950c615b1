"""Ranks in sliding frames of years against pools sorted anew for each year and day."""

import numpy as np
import pytest

from gridloom.operators import windows


def expected(days, values, half, years):
    q, year = np.full(len(values), np.nan), windows._years(days)
    for y in np.unique(year):
        low, high = windows._new_year(y - years) - half, windows._new_year(y + years + 1) + half
        frame = slice(np.searchsorted(days, low), np.searchsorted(days, high))
        q[np.flatnonzero(year == y)] = windows.doy_ranks(days[frame], values[frame], half)[year[frame] == y]
    return q


@pytest.mark.parametrize("n, half, years, gap", [(365 * 9 + 3, 15, 2, 0.0), (365 * 6, 7, 1, 0.2), (365 * 5, 3, 0, 0.5), (400, 15, 10, 0.9), (365 * 4 + 1, 0, 1, 0.3), (700, 15, 1, 0.97), (1, 15, 1, 0.0)])
def test_equal_ranks(n, half, years, gap):
    rng = np.random.default_rng(n + half)
    for _ in range(3):
        first = int(rng.integers(8000, 12000))
        days = np.arange(first, first + n)
        days = days[rng.random(n) >= gap]
        values = np.round(rng.gamma(1, 2, len(days)), int(rng.integers(0, 3)))
        values[rng.random(len(values)) < 0.05] = np.nan
        if len(days):
            assert np.allclose(windows.sliding_ranks(days, values, half, years), expected(days, values, half, years), equal_nan=True, atol=1e-12)


def test_all_null():
    assert np.isnan(windows.sliding_ranks(np.arange(100), np.full(100, np.nan), 3, 1)).all()


def test_work_follows_years_and_not_frames():
    """Entries and departures are counted: a year's windows come and go once, whatever the frame."""
    put, n = windows.RankCounts.put, []
    days = np.arange(7000, 7000 + 365 * 40)
    values = np.random.default_rng(0).gamma(1, 2, len(days))
    windows.RankCounts.put = lambda self, lane, rank, times=1: (n.append(len(lane)), put(self, lane, rank, times))[1]
    try:
        took = []
        for years in (2, 15):
            n.clear()
            windows.sliding_ranks(days, values, 7, years)
            took.append(sum(n))
    finally:
        windows.RankCounts.put = put
    assert took[1] <= took[0] <= 2.2 * 15 * len(days)


def test_counts():
    counts, rng = windows.RankCounts(3, 50), np.random.default_rng(1)
    held = [[], [], []]
    for _ in range(200):
        lane, rank = int(rng.integers(3)), int(rng.integers(50))
        held[lane].append(rank)
        counts.put(np.array([lane]), np.array([rank]))
        if rng.random() < 0.4:
            gone = held[lane].pop(int(rng.integers(len(held[lane]))))
            counts.put(np.array([lane]), np.array([gone]), -1)
    for rank in range(50):
        below, equal, total = counts.ask(np.arange(3), np.full(3, rank))
        assert below.tolist() == [sum(x < rank for x in h) for h in held] and equal.tolist() == [h.count(rank) for h in held] and total.tolist() == [len(h) for h in held]
