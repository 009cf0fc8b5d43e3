"""Pfair mixing against slot-by-slot earliest deadline first, and the less-than-one-block property on exact targets."""

import random
from collections import Counter

import numpy as np
import pytest

from rollwise.llm import mixing


def simulate(p, whole, slots):
    """(source, block) of every slot by the rule itself, one slot after the other."""
    done, out = [0] * len(p), []
    for t in range(slots):
        ready = [(-(-(k + 1) * whole // x), s) for s, (x, k) in enumerate(zip(p, done)) if k * whole // x <= t]
        s = min(ready)[1]
        out.append((s, done[s]))
        done[s] += 1
    return out


def draws(n, seed=0):
    r = random.Random(seed)
    for _ in range(n):
        size = r.choice([1, 2, 3, 7, 30])
        kind = r.random()
        if kind < 0.3:
            yield [r.randint(1, 5) for _ in range(size)]
        elif kind < 0.45:
            yield [r.randint(1, 400) ** 0.5 for _ in range(size)]
        elif kind < 0.6:
            yield [r.random() ** 6 + 1e-4 for _ in range(size)]
        else:  # one or two heavy sources and many light ones, where releases bind
            yield [1.0, r.choice([0.5, 0.9, 1.0])] + [r.choice([1e-3, 1e-2, 0.03])] * size


def test_ranges_equal_the_whole_schedule():
    for weights in draws(60):
        p, whole = mixing.shares(weights)
        assert sum(p) == whole and min(p) >= 1
        want = simulate(p, whole, 400)
        table = mixing.Timetable(p, whole, [10**6] * len(p))
        for first in (0, 1, 7, 50, 199, 333):
            got = list(table.slots(first, 400))
            assert [x[:2] for x in got] == want[first:], (weights, first)
            assert all(x[2] == t and x[3] <= t < x[4] for t, x in enumerate(got, first))


def test_deviation_stays_under_one_block_of_the_target():
    weights = [0.5, 0.3000003, 0.1999887, 0.000011]
    table = mixing.Timetable(*mixing.shares(weights), [10**7] * 4)
    slots = 10**6
    got = np.array([x[0] for lo in range(0, slots, 1 << 16) for x in table.slots(lo, min(lo + (1 << 16), slots))])
    at = np.arange(1, slots + 1)
    for s, w in enumerate(weights):
        target = at * w
        assert np.abs(np.cumsum(got == s) - target).max() < 1


def test_far_slots_are_exact():
    for weights in ([3, 2, 1e-5, 0.7], [3**0.5, 2**0.5, 1e-5, 0.7]):
        p, whole = mixing.shares(weights)
        table = mixing.Timetable(p, whole, [10**15] * 4)
        for t in (5, (1 << 31) - 1, 1 << 31, 1 << 45):
            assert table.due(t).tolist() == [x * t // whole for x in p]
            assert table.released(t).tolist() == [-(-x * t // whole) for x in p]
            assert int(table.done(t).sum()) == t


def test_many_sources():
    r = random.Random(1)
    counts = [r.randint(1, 400) for _ in range(20_000)]
    table = mixing.Timetable(*mixing.shares([c**0.5 for c in counts]), [-(-c // 32) for c in counts])
    on = [x for lo in range(0, table.end, 1 << 14) for x in table.slots(lo, min(lo + (1 << 14), table.end))]
    rest = [x for lo in range(0, table.total - table.end, 1 << 14) for x in table.rest(lo, min(lo + (1 << 14), table.total - table.end))]
    assert [x[2] for x in on + rest] == list(range(table.total))
    assert Counter(x[0] for x in on + rest) == Counter({s: -(-c // 32) for s, c in enumerate(counts)})
    assert [(x[4], x[0]) for x in rest] == sorted((x[4], x[0]) for x in rest)


def test_weights_are_checked():
    with pytest.raises(ValueError):
        mixing.shares([1, 0])
    with pytest.raises(ValueError):
        mixing.shares([1, -1])
    assert mixing.shares([1e-300, 1.0]) == ([1, mixing.WHOLE - 1], mixing.WHOLE)
    assert mixing.shares([0.5, 0.25, 0.25]) == ([2, 1, 1], 4)


def expected(blocks, weights):
    """Slot of every block: the simulation up to the first source's end, the others by deadline."""
    p, whole = mixing.shares(weights)
    end = min(b * whole // x for x, b in zip(p, blocks))
    slots = {x: t for t, x in enumerate(simulate(p, whole, end))}
    left = sorted((-(-(k + 1) * whole // p[s]), s, k) for s, b in enumerate(blocks) for k in range(b) if (s, k) not in slots)
    return slots | {(s, k): end + i for i, (_, s, k) in enumerate(left)}, end


@pytest.mark.parametrize("weights", [None, {"a": 1, "b": 5, "c": 2.5, None: 1}, {"a": 1, "b": 1e-7, "c": 1, None: 1e-3}])
def test_schedule_matches_simulation(spark, weights, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_SLOTS", 17)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rows = [(i, "t", "a") for i in range(700)] + [(i, None, "b") for i in range(60)] + [(i, "", "c") for i in range(33)] + [(None, "x", None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("slot", mixing.F.lit("clash"))
    out = mixing.schedule(df, weights, block_rows=8).collect()
    assert len(out) == len(rows) and Counter((r["doc_id"], r["source"]) for r in out) == Counter((a, c) for a, _, c in rows)
    sizes = Counter(r["source"] for r in out)
    order = sorted(sizes, key=lambda s: (s is None, s))
    given = [sizes[s] ** 0.5 if weights is None else weights[s] for s in order]
    want, end = expected([-(-sizes[s] // 8) for s in order], given)
    assert {(order.index(r["source"]), r["block"]): r["slot"] for r in out} == want
    assert all(v == 8 or b == (sizes[s] - 1) // 8 for (s, b), v in Counter((r["source"], r["block"]) for r in out).items())
    assert len({r["mix_position"] for r in out}) == len(out) and all(r["mix_position"] // 8 == r["slot"] for r in out)
    assert all(r["on_target"] == (r["slot"] < end) for r in out)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in out if r["on_target"])


def test_mix_keeps_rows_in_order(spark):
    rows = [(i, f"t{i}", "ab"[i % 3 == 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, block_rows=8)
    assert out.columns == df.columns
    place = {r["doc_id"]: r["mix_position"] for r in mixing.schedule(df, block_rows=8).collect()}
    got = [r["doc_id"] for r in out.collect()]
    assert got == sorted(got, key=place.get) and len(got) == 300
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.schedule(df.limit(0)).count() == 0
