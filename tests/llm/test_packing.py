import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm.packing import combinations, containers, nnls, pack


def check(lengths, capacity):
    rows = pack(np.array(lengths, dtype=np.int64), capacity)
    load, parts = {}, {}
    for i, part, chars, c, _ in rows:
        load[c] = load.get(c, 0) + chars
        parts.setdefault(i, []).append((part, chars))
    assert max(load.values(), default=0) <= capacity and sorted(parts) == list(range(len(lengths)))
    for i, ps in parts.items():
        assert sum(n for _, n in ps) == lengths[i] and [p for p, _ in sorted(ps)] == list(range(len(ps)))
        assert len(ps) == max(1, -(-lengths[i] // capacity))
    return load


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 250), max_size=60))
def test_every_item_once_and_whole(lengths):
    check(lengths, 100)


def test_fill():
    rnd = random.Random(3)
    lengths = [rnd.randint(5, 90) for _ in range(2000)]
    load = check(lengths, 100)
    assert sum(lengths) / (100 * len(load)) > 0.97


def greedy(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        best = min((r for r in rooms if r >= n), default=None)
        if best is None:
            best = capacity
        else:
            rooms.remove(best)
        rooms.append(best - n)
    return len(rooms)


def test_plans_place_most_items_and_fill_as_well_as_greedy():
    """Short, middling and long items for one capacity: containers of a few and of many items."""
    rng = np.random.default_rng(7)
    for scale in (0.35, 0.08, 0.02):
        lengths = np.clip(rng.lognormal(np.log(scale * 6000), 0.9, 1500), 1, 6000).astype(int)
        rows = pack(lengths, 6000)
        check(lengths.tolist(), 6000)
        assert sum(planned for *_, planned in rows) > 0.5 * len(rows)
        assert len({c for *_, c, _ in rows}) <= 1.015 * greedy(lengths.tolist(), 6000)


def test_combinations_fill_the_window():
    got = combinations([4, 10, 16, 30], 32, 2)
    assert all(31 <= sum(c) <= 32 and len(c) <= 3 for c in got) and (16, 16) in got and (4, 4, 4) not in got


def test_nnls_against_projected_gradient():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.integers(0, 3, (8, 12)).astype(float), rng.random(8) * 10
        x, y = nnls(a, b), np.zeros(12)
        step = 1 / np.linalg.norm(a.T @ a, 2)
        for _ in range(20_000):
            y = np.maximum(0, y - step * (a.T @ (a @ y - b)))
        assert (x >= 0).all() and np.linalg.norm(a @ x - b) <= np.linalg.norm(a @ y - b) + 1e-4


def test_frame(spark):
    rows = [(i, "hot" if i % 3 else None, (i * 37) % 260 if i % 11 else None) for i in range(600)] + [(5, "hot", 10)]
    df = spark.createDataFrame(rows, "section_id long, company string, chars int").selectExpr("*", "'x' owner", "1 part_no")
    got = containers(df, [("s", 100), ("l", 1000), ("none", None)], "company", "section_id", "chars", shard_rows=100).collect()
    for name, cap in (("s", 100), ("l", 1000)):
        mine = [r for r in got if r.limit_name == name]
        load = {}
        for r in mine:
            load[r.company, r.container] = load.get((r.company, r.container), 0) + r.part_chars
        assert max(load.values()) <= cap and sum(r.part_chars for r in mine) == sum(n or 0 for *_, n in rows)
        assert len({r.container.split("-")[0] for r in mine if r.company == "hot"}) > 1
    assert containers(df.limit(0), [("s", 100)], "company", "section_id", "chars").count() == 0
    assert containers(df, [], "company", "section_id", "chars").count() == 0
