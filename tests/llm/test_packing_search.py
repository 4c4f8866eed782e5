"""The packing search against exact optima and its own lower bound."""

import random
from collections import Counter

import pytest

pytest.importorskip("tessera.llm")
from tessera.llm.packing import best_fit, fewest, mended, plan_fillings, search  # noqa: E402
from tessera.llm.packing import sequences as n_sequences  # noqa: E402


def optimum(pieces: list[int], capacity: int) -> int:
    """By trying every sequence for every piece."""
    pieces, best = sorted(pieces, reverse=True), len(pieces)

    def go(i: int, rooms: tuple[int, ...]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= pieces[i] and room not in rooms[:j]:
                go(i + 1, rooms[:j] + (room - pieces[i],) + rooms[j + 1:])
        go(i + 1, (*rooms, capacity - pieces[i]))

    go(0, ())
    return best


def holds(plan, histogram, capacity) -> bool:
    placed = Counter()
    for filling, copies in plan:
        assert sum(filling) <= capacity and copies > 0
        for size in filling:
            placed[size] += copies
    return placed == +Counter(histogram)


def test_small_histograms_are_packed_into_the_fewest_sequences():
    rng = random.Random(3)
    for _ in range(600):
        capacity = rng.choice([10, 20, 37, 50])
        pieces = [rng.randint(1, capacity) if rng.random() < 0.3
                  else rng.randint(max(1, capacity // 5), capacity // 2 + 1)
                  for _ in range(rng.randint(0, 11))]
        histogram, best = Counter(pieces), optimum(pieces, capacity)
        plan = plan_fillings(histogram, capacity)
        assert holds(plan, histogram, capacity)
        assert n_sequences(plan) == best and fewest(histogram, capacity) <= best, pieces


def test_best_completion_is_exact():
    # the largest piece that fits beside 50 would waste 1; 30 + 19 + 1 wastes nothing
    first = next(iter(search({50: 1, 49: 1, 30: 1, 19: 1, 1: 1, 40: 1}, 100, None, None)))
    assert first == ((50, 49, 1), 1)
    first = next(iter(search({50: 1, 48: 1, 30: 1, 19: 1, 1: 1}, 100, None, None)))
    assert first == ((50, 30, 19, 1), 1)


def test_full_sequences_cut_into_four_are_found_again_but_for_one():
    rng, pieces = random.Random(0), []
    while len(pieces) < 400:
        part = [rng.randint(700, 1100) for _ in range(3)]
        if 700 <= 4096 - sum(part) <= 1100:
            pieces += [*part, 4096 - sum(part)]
    histogram = Counter(pieces)
    plan = plan_fillings(histogram)
    assert holds(plan, histogram, 4096)
    assert fewest(histogram) == 100 <= n_sequences(plan) <= 101
    assert n_sequences(best_fit(histogram, 4096)) > 101


def test_counts_of_any_size_and_repeated_fillings():
    for histogram in ({1400: 10**9}, {4096: 5}, {s: 10**6 for s in range(1, 400)}, {}):
        plan = plan_fillings(histogram)
        assert holds(plan, histogram, 4096)
    assert n_sequences(plan_fillings({1400: 10**9})) == 5 * 10**8
    # the same filling twice in a plan keeps all its copies
    again = mended([((6,), 2), ((6,), 1), ((4,), 3)], 10, 100, random.Random(0))
    assert holds(again, {6: 3, 4: 3}, 10)
