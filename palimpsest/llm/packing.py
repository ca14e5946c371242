"""Filling containers of fixed capacity with items of varying length (problem 3).

Items of one owner are laid out by a histogram of their lengths in `bins` steps of a window, rounded up. Combinations of at
most three steps that fill the window to within `gap` steps are the columns of a non-negative least-squares problem, whose
solution says how often each is repeated; rounded, they are filled with real items, the smallest of each combination being
the longest that fits by its true length, and what leaves more than SLACK unused is planned again. Windows are halves of halves of the capacity: what fills a small window is one item
of the next larger one, so that containers of many short items come from shallow combinations as well. The last window is the
container. What no plan took goes greedily, longest first, into the container with the least sufficient room (new ones being
opened only where none has room), blocks of small windows being taken apart for it.

An owner with many items is split into shards by a hash of the item, so that no task gets more than about `shard_rows`
items; a shard costs at most one badly filled container.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import spread

BINS, GAP, ROUNDS, SHARD_ROWS = 64, 2, 4, 5_000
RESERVE, SLACK = 0.02, 0.01  # share of all characters, in the shortest items, kept back to fill rooms; of a window that a plan may leave unused
WEIGHT = 2.0  # power of the length by which errors of the histogram count, so that long items are planned for first


def combinations(present: list[int], bins: int = BINS, gap: int = GAP) -> list[tuple[int, ...]]:
    """Ascending combinations of one to three of the present steps whose sum lies within `gap` steps of full."""
    low, have, out = bins - gap + 1, sorted(set(present)), []
    for i, a in enumerate(have):
        if a >= low:
            out.append((a,))
        for j in range(i, len(have)):
            b = have[j]
            if a + b > bins:
                break
            if a + b >= low:
                out.append((a, b))
            for k in range(max(j, bisect_left(have, low - a - b)), len(have)):
                if a + b + have[k] > bins:
                    break
                out.append((a, b, have[k]))
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares by an active set: grow the set by the steepest column, shrink it where a weight turns negative.

    It ends where no column can lower the error; the error falls with every step, so no active set recurs.
    """
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    gram, rhs = a.T @ a, a.T @ b
    scale = max(1.0, float(np.abs(b).max(initial=0.0)))
    best = np.inf
    while True:
        rest = b - a @ x
        error = float(rest @ rest)
        if error >= best - 1e-12 * scale * scale:  # no step lowers it any more but by rounding
            return x
        best = error
        slope = a.T @ rest
        slope[active] = -np.inf
        j = int(np.argmax(slope)) if n else -1
        if j < 0 or slope[j] <= 1e-9 * scale:
            return x
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            try:
                z = np.linalg.solve(gram[np.ix_(at, at)], rhs[at])
            except np.linalg.LinAlgError:
                z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[at] = z
                break
            bad = z <= 1e-12
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - z[bad], 1e-12))
            x[at] += step * (z - x[at])
            active[at[x[at] <= 1e-12]] = False
            x[~active] = 0


def fill_windows(lengths: list[int], window: int, slack: float, bins: int = BINS, gap: int = GAP) -> list[list[int]]:
    """Groups of items that fill one window each, as the solution of the histogram says; the rest of the items is in none."""
    piles: dict[int, list[tuple[int, int]]] = {}
    for i, n in enumerate(lengths):
        if 0 < n <= window:
            piles.setdefault(-(-n * bins // window), []).append((n, i))
    for pile in piles.values():
        pile.sort()
    combos = combinations(list(piles), bins, gap)
    if not combos:
        return []
    used = np.zeros((bins + 1, len(combos)))
    for k, combo in enumerate(combos):
        for s in combo:
            used[s, k] += 1
    hist = np.array([len(piles.get(s, ())) for s in range(bins + 1)], float)
    weight = np.arange(bins + 1, dtype=float)[:, None] ** WEIGHT
    times = nnls(used * weight, hist * weight[:, 0])
    groups = []
    for k in np.argsort(-times, kind="stable"):
        smallest, *others = combos[k]
        for _ in range(int(times[k] + 0.5)):
            need = Counter(combos[k])
            if any(len(piles[s]) < n for s, n in need.items()):
                break
            taken = [piles[s].pop() for s in others]
            room = window - sum(n for n, _ in taken)
            # rounding up left some room: the smallest may be of a slightly longer step, but what other steps plan for stays
            for s in range(min(smallest + len(others) + gap, bins), smallest - 1, -1):
                pile = piles.get(s, [])
                at = bisect_left(pile, (room + 1, -1)) - 1
                if at >= 0 and (s == smallest or len(pile) > 1):
                    taken.append(pile.pop(at))
                    break
            if window - sum(n for n, _ in taken) > slack * window:
                for n, i in taken:  # too much would stay unused
                    insort(piles[-(-n * bins // window)], (n, i))
                break
            groups.append([i for _, i in taken])
    return groups


def pack(lengths: np.ndarray, capacity: int, bins: int = BINS, gap: int = GAP) -> list[tuple[int, int, int, int, bool]]:
    """(item, part, characters, container, whether a plan placed it) rows: every item whole in one container unless it is longer
    than the capacity, in which case full parts get containers of their own and the rest is packed like an item."""
    rows: list[tuple[int, int, int, int, bool]] = []
    room: list[int] = []
    part = np.zeros(len(lengths), np.int64)
    rest = lengths.astype(np.int64).copy()
    for i in np.flatnonzero(lengths > capacity):
        full, left = divmod(int(lengths[i]), capacity)
        full, left = (full - 1, capacity) if left == 0 else (full, left)
        for p in range(full):
            rows.append((int(i), p, capacity, len(room), True))
            room.append(0)
        part[i], rest[i] = full, left

    def put(i: int, c: int, planned: bool) -> None:
        rows.append((i, int(part[i]), int(rest[i]), c, planned))
        room[c] -= int(rest[i])

    pool = [[int(i)] for i in np.lexsort((np.arange(len(lengths)), rest))]  # blocks of items, at first of one
    size = [int(rest[b[0]]) for b in pool]
    spare, kept_back = RESERVE * float(rest.sum()), []
    while pool and len(kept_back) < len(lengths) and spare >= size[len(kept_back)]:
        spare -= size[len(kept_back)]
        kept_back.append(pool[len(kept_back)])
    pool, size = pool[len(kept_back) :], size[len(kept_back) :]
    halvings = 0
    while pool and capacity >> (halvings + 1) >= 2 * bins and capacity >> (halvings + 1) >= np.median(size):
        halvings += 1
    for k in range(halvings, -1, -1):
        groups = []
        left = list(range(len(size)))
        for _ in range(ROUNDS):  # what a plan could not fill well is planned again
            more = [[left[b] for b in g] for g in fill_windows([size[b] for b in left], capacity >> k, SLACK, bins, gap)]
            groups += more
            used = {b for g in more for b in g}
            left = [b for b in left if b not in used]
            if not more:
                break
        if k == 0:
            for g in groups:
                room.append(capacity)
                for b in g:
                    for i in pool[b]:
                        put(i, len(room) - 1, True)
        gone = {b for g in groups for b in g}
        made = [] if k == 0 else [([i for b in g for i in pool[b]], sum(size[b] for b in g)) for g in groups]
        kept = [(b, n) for j, (b, n) in enumerate(zip(pool, size)) if j not in gone] + made
        pool, size = [b for b, _ in kept], [n for _, n in kept]
    free = sorted((r, c) for c, r in enumerate(room) if r > 0)
    for i in sorted((i for b in pool + kept_back for i in b), key=lambda i: (-rest[i], i)):
        at = bisect_left(free, (int(rest[i]), -1))
        if at < len(free):
            _, c = free.pop(at)
        else:
            c = len(room)
            room.append(capacity)
        put(i, c, False)
        if room[c] > 0:
            insort(free, (room[c], c))
    return rows


def containers(items: DataFrame, limits: list[tuple[str, int]], owner: str, item: str, length: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(limit_name, owner, item, part_no, part_chars, container, planned) of every item under every limit; planned: placed by the
    solution of the least squares, not greedily (full parts of items longer than a container count as planned).

    limits: the few rows of the fixed table of limits; limits of null or no capacity are left out. A null owner is an owner
    of its own; a null length counts 0. Items delivered twice under one id are packed twice. An empty item takes a place in
    some container. Columns beyond those named are ignored.
    """
    known = [(n, int(c)) for n, c in limits if n is not None and c and c > 0]
    rows = items.select(F.col(owner).alias("owner"), F.col(item).cast("long").alias("item"), F.coalesce(F.col(length), F.lit(0)).cast("long").alias("len"))
    sizes = rows.groupBy(F.col("owner").alias("whose")).agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    placed = (
        rows.join(sizes, F.col("owner").eqNullSafe(F.col("whose"))).select("owner", "item", "len", F.pmod(F.xxhash64("item"), "shards").alias("shard"))
        .withColumn("limit", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("capacity")) for n, c in known] or [F.lit(None).cast("struct<name:string,capacity:int>")])))
        .where("limit is not null").select("owner", "item", "len", "shard", F.col("limit.name").alias("limit_name"), F.col("limit.capacity").alias("capacity"))
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["item", "len"], kind="stable")
        got = pd.DataFrame(pack(pdf["len"].to_numpy(), int(pdf["capacity"].iloc[0])), columns=["i", "part_no", "part_chars", "c", "planned"])
        return pd.DataFrame({
            "limit_name": pdf["limit_name"].iloc[0], "owner": pdf["owner"].iloc[0], "item": pdf["item"].to_numpy()[got["i"].to_numpy(int)],
            "part_no": got["part_no"], "part_chars": got["part_chars"], "container": f"{pdf['shard'].iloc[0]}-" + got["c"].astype(str), "planned": got["planned"].astype(bool),
        })

    out = spread(placed, "limit_name", "owner", "shard").groupBy("limit_name", "owner", "shard").applyInPandas(run, "limit_name string, owner string, item long, part_no int, part_chars long, container string, planned boolean")
    return out.withColumnsRenamed({"owner": owner, "item": item})
