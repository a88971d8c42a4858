"""Order-keeping one-to-one matching of two ascending series of times."""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np


def match(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of few the place of its partner in many: no partner twice, in the same order, the sum of distances least.

    Both series are gone through together in the order of time, and the least sum so far is kept by exchanges: a row of few takes the
    partner that is cheapest now, one of many takes the place of another where that lowers the sum. An exchange adds one partner to the
    taken ones or swaps one, and what it would cost to undo it lies in a heap, so that the time is n log n and the memory linear. In the end
    the taken ones are dealt out in order. Of equal sums the earlier partners are taken.
    """
    n, size = len(few), len(many)
    if size < n:
        raise ValueError("the second series must not be the shorter one")
    if n == size:
        return np.arange(n)
    few, many = few.tolist(), many.tolist()
    taken = bytearray(size)
    free, swaps = [], []  # (cost but for the time of the row of few, partner gained), (cost but for the time of the one of many, -partner lost)
    later, owed = [], []  # the same where a row of few has no partner yet; whatever the cost, these are the last and the first choice
    i = 0
    for j, y in enumerate(many):
        while i < n and few[i] <= y:
            x = few[i]
            i += 1
            if free:
                cost, gained = heappop(free)
                taken[gained] = 1
                heappush(swaps, (-x - (x + cost), -gained))
            else:
                cost = heappop(later) if later and later[0] < 0 else 0
                heappush(owed, -x - (x + cost))
        if owed:
            heappush(later, -y - (y + heappop(owed)))
            taken[j] = 1
        elif swaps and swaps[0][0] + y < 0:
            cost, lost = heappop(swaps)
            taken[-lost], taken[j] = 0, 1
            heappush(free, (-y - (y + cost), -lost))
        else:
            heappush(free, (-y, j))
    for x in few[i:]:
        cost, gained = heappop(free)
        taken[gained] = 1
    return np.flatnonzero(np.frombuffer(taken, np.uint8))
