"""Karmarkar-Karp differencing against a plain version that looks at all partial partitions."""

import random

import pytest

from feederlens.llm import sharding


def plain(sizes, parts):
    """Sums of the parts; the two partial partitions of largest spread are combined in opposite order."""
    partial = [[[size], *[[] for _ in range(parts - 1)]] for size in sizes]
    spread = lambda p: sum(p[0]) - sum(p[-1])
    while len(partial) > 1:
        one, other, *rest = sorted(partial, key=spread, reverse=True)
        joined = sorted((a + b for a, b in zip(one, reversed(other), strict=True)), key=sum, reverse=True)
        partial = [joined, *rest]
    return sorted(map(sum, partial[0]))


@pytest.mark.parametrize("seed", range(12))
def test_difference_is_plain_differencing(seed):
    draw = random.Random(seed)
    parts = draw.choice([2, 3, 5, 16])
    # Large sizes, so that no two partial partitions tie.
    sizes = [draw.randrange(1, 10**9) for _ in range(draw.choice([1, 2, 7, 60, 150]))]
    sums = [0] * parts
    for size, part in zip(sizes, sharding.difference(sizes, parts), strict=True):
        sums[part] += size
    assert sorted(sums) == plain(sizes, parts)
