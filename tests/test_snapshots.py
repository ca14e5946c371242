import random

from palimpsest.operators.snapshots import snapshot_changes

SCHEMA = "chunk_id long, company string, policy string, version_ts string, chunk_idx int, text string, loaded_at long, key string, idx int, version int"


def brute(rows):
    best = {}
    for r in rows:
        cid, c, p, v, k, t, at = r[:7]
        if None in (c, p, v, k):
            continue
        rank = (at is not None, at or 0, cid)
        if (c, p, v, k) not in best or rank > best[c, p, v, k][0]:
            best[c, p, v, k] = (rank, t)
    pages = {}
    for (c, p, v, k), (_, t) in best.items():
        pages.setdefault((c, p), {}).setdefault(v, {})[k] = t
    out = []
    for (c, p), vs in pages.items():
        order = sorted(vs)
        for a, b in zip(order, order[1:]):
            for k in vs[a].keys() | vs[b].keys():
                kind = "added" if k not in vs[a] else "removed" if k not in vs[b] else "changed" if vs[a][k] != vs[b][k] else None
                if kind:
                    out.append((c, p, b, k, kind))
    return sorted(out)


def test_against_brute_force(spark):
    rnd = random.Random(9)
    rows = [
        (i, rnd.choice(["a", "b", None]), rnd.choice(["p", "p-2"]), rnd.choice(["1", "2", "3", "4", None]), rnd.choice([0, 1, 2, 3, None]), rnd.choice(["x", "y", "", None]), rnd.choice([1, 2, None]), "k", 1, 2)
        for i in range(400)
    ]
    got = sorted(map(tuple, snapshot_changes(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == brute(rows) and got


def test_hot_page_of_one_chunk(spark):
    rows = [(i, "a", "p", f"{i:04d}", 0, "x" if i % 3 else "y", 1, "k", 1, 2) for i in range(300)]
    assert sorted(map(tuple, snapshot_changes(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_empty_and_single(spark):
    assert snapshot_changes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert snapshot_changes(spark.createDataFrame([(1, "a", "p", "1", 0, "x", 1, "k", 1, 2)], SCHEMA)).count() == 0
