"""Schema drift between consecutive files of a feed.

Each file's records are read into typed leaves; the schema of a file is the tree of its leaf paths. Consecutive files
of a feed are compared by a constrained tree edit distance: nodes of the same label match at no cost and are compared
below; a leaf may be relabelled to a sibling leaf and an object to a sibling object whose values agree on the summaries
both files hold, or a leaf moved under another parent on the same evidence; what is left is deleted or inserted. The
cheapest script has steps removed, added, renamed, renamed_node and moved; change rows tell a move as a field removed and
a field added. The scripts are then compiled to one projection per file, which reads every record into the same typed columns.

Values travel as 64-bit marks, one row a record. They are looked at only between files whose paths differ: there each field
that vanished or appeared gets a signature over the summaries both files hold, and fields of equal signature agree. Python sees
one row per pair of files with its two trees, and one row per change when types are followed through renames.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from hashlib import blake2b
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import spread

DELETE, INSERT, RELABEL, MOVE, FORBIDDEN = 1.0, 1.0, 0.5, 0.75, 1e6
MOST_COLUMNS = 1_000  # fields that get a column of their own, those of most files first

SHAPES_SCHEMA = "file_id long, line_no int, summary_key string, paths array<string>, kinds array<string>, marks array<long>"


def kind_of(value: object) -> str | None:
    """boolean, integer, decimal, string or array; None for null."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, float):
        return "decimal"
    return "string" if isinstance(value, str) else "array"


def leaves_of(obj: dict, prefix: str = "") -> list[tuple[str, object]]:
    """Leaves of an object by dotted path; arrays are leaves, an empty object has none."""
    out, stack = [], [(prefix, obj)]
    while stack:
        at, node = stack.pop()
        for k, v in node.items():
            path = f"{at}.{k}" if at else k
            if isinstance(v, dict):
                stack.append((path, v))
            else:
                out.append((path, v))
    return out


def parsed(text: str | None) -> dict | None:
    """The JSON object a line holds; None for any other line."""
    try:
        obj = json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None
    return obj if isinstance(obj, dict) else None


def mark_of(value: object) -> int:
    """64 bits that tell values (and types) apart; 0 for null."""
    if value is None:
        return 0
    text = "s" + value if isinstance(value, str) else json.dumps(value, sort_keys=True) if isinstance(value, list) else repr(value)
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 1


def _shapes(batches):
    for batch in batches:
        cols: list[list] = [[] for _ in range(6)]
        for *own, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (obj := parsed(text)) is not None:
                leaves = leaves_of(obj)
                for col, x in zip(cols, (*own, [p for p, _ in leaves], [kind_of(v) for _, v in leaves], [mark_of(v) for _, v in leaves])):
                    col.append(x)
        types = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["file_id", "line_no", "summary_key", "paths", "kinds", "marks"])


def record_shapes(records: DataFrame) -> DataFrame:
    """Paths, types and marks of the leaves of every record that is a JSON object; broken, empty and other lines are left out."""
    return records.select("file_id", "line_no", "summary_key", "raw_json").mapInArrow(_shapes, SHAPES_SCHEMA)


def file_order(files: DataFrame) -> DataFrame:
    """Each file with the one before it in its feed by produced_at (ties and nulls by file_id; nulls come first)."""
    by = Window.partitionBy("feed").orderBy(F.col("produced_at").asc_nulls_first(), "file_id")
    return files.select("file_id", "feed", "produced_at").dropDuplicates(["file_id"]).select(
        "file_id", "feed", F.row_number().over(by).alias("seq"), F.lag("file_id").over(by).alias("prev_id")
    )


def file_fields(shapes: DataFrame) -> DataFrame:
    """Fields of each file with their type: of the values that are not null; of several the first in the order
    array, boolean, decimal, integer, string."""
    leaf = shapes.select("file_id", F.explode(F.arrays_zip("paths", "kinds")).alias("f"))
    return leaf.groupBy("file_id", F.col("f.paths").alias("path")).agg(F.min("f.kinds").alias("kind"))


def _children(paths: list[str]) -> dict:
    root: dict = {}
    for p in sorted(paths):
        node = root
        parts = p.split(".")
        for i, part in enumerate(parts):
            # a label may be both a leaf and an object (in different records of a file): kept apart
            node = node.setdefault((part, i == len(parts) - 1), {})
    return root


def assign(cost: list[list[float]]) -> list[int]:
    """Minimum-cost assignment of each row of a square matrix to a column (shortest augmenting paths)."""
    n = len(cost)
    u, v, match = [0.0] * (n + 1), [0.0] * (n + 1), [n] * (n + 1)
    for row in range(n):
        match[n], col = row, n
        least, came, done = [float("inf")] * (n + 1), [n] * (n + 1), [False] * (n + 1)
        while True:
            done[col] = True
            r, delta, nxt = match[col], float("inf"), n
            for j in range(n):
                if not done[j]:
                    c = cost[r][j] - u[r] - v[j]
                    if c < least[j]:
                        least[j], came[j] = c, col
                    if least[j] < delta:
                        delta, nxt = least[j], j
            for j in range(n + 1):
                if done[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            col = nxt
            if match[col] == n:
                break
        while col != n:
            match[col] = match[came[col]]
            col = came[col]
    out = [0] * n
    for j in range(n):
        out[match[j]] = j
    return out


def _matched(gone: list[str], come: list[str], cost_of) -> tuple[float, dict[str, str]]:
    """Cheapest matching of what vanished with what appeared, where the cost of a pair is that of deleting and inserting both or less."""
    n = len(gone) + len(come)
    cost = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i < len(gone) and j < len(come):
                cost[i][j] = cost_of(gone[i], come[j])
            elif i < len(gone):
                cost[i][j] = DELETE if j - len(come) == i else FORBIDDEN
            elif j < len(come):
                cost[i][j] = INSERT if i - len(gone) == j else FORBIDDEN
    pairs = [(gone[i], come[j], cost[i][j]) for i, j in enumerate(assign(cost)) if i < len(gone) and j < len(come)]
    return sum(c for *_, c in pairs), {x: y for x, y, _ in pairs}


def _within(path: str) -> str:
    return path.rpartition(".")[0]


def edit_script(before: list[str], after: list[str], agreement: dict[tuple[str, str], float]) -> tuple[float, list[tuple[str, str, str]]]:
    """Cheapest script between two schema trees: its cost and (step, old path, new path) rows.

    agreement: evidence (values that agree) of each two leaves that may be one field; more of it is a little cheaper. The trees are
    unordered; since labels are unique among siblings, the distance splits into one assignment per pair of matched inner
    nodes, one of the inner nodes left under the same parent, and one of the leaves left anywhere. The steps of leaves below
    a renamed node are given as moved and cost nothing more.
    """
    script: list[tuple[str, str, str]] = []
    gone: dict[str, list[str]] = {}  # leaves left over, by the topmost vanished node above them (a leaf by itself)
    come: dict[str, list[str]] = {}
    cost = 0.0

    def leaves(node: dict, at: str) -> list[str]:
        return [x for (label, leaf), below in node.items() for x in ([f"{at}.{label}"] if leaf else leaves(below, f"{at}.{label}"))]

    todo = [(_children(before), _children(after), "")]
    while todo:
        x, y, at = todo.pop()
        path = lambda k, at=at: f"{at}.{k[0]}" if at else k[0]
        todo += [(x[k], y[k], path(k)) for k in x.keys() & y.keys() if not k[1]]
        for mine, other, left in ((x, y, gone), (y, x, come)):
            left.update({path(k): leaves(mine[k], path(k)) for k in mine.keys() - other.keys() if not k[1]})
        old, new = (sorted(path(k) for k in p.keys() - q.keys() if k[1]) for p, q in ((x, y), (y, x)))
        more, pairs = _matched(old, new, lambda p, q: RELABEL + 0.25 / (1 + agreement[p, q]) if (p, q) in agreement else FORBIDDEN)
        cost += more
        script += [("renamed", p, q) for p, q in pairs.items()]
        gone.update({p: [p] for p in old if p not in pairs})
        come.update({q: [q] for q in new if q not in pairs.values()})

    def of_node(p: str, q: str) -> float:
        inside = [(a, q + a[len(p) :]) for a in gone[p]]
        if p in gone[p] or q in come[q] or _within(p) != _within(q) or sorted(b for _, b in inside) != sorted(come[q]) or not all(pair in agreement for pair in inside):
            return FORBIDDEN
        return RELABEL + 0.25 / (1 + sum(agreement[pair] for pair in inside))

    more, nodes = _matched(sorted(p for p in gone if p not in gone[p]), sorted(q for q in come if q not in come[q]), of_node)
    cost += more
    for p, q in nodes.items():
        script += [("renamed_node", p, q), *(("moved", a, q + a[len(p) :]) for a in gone.pop(p))]
        come.pop(q)
    old, new = sorted(x for xs in gone.values() for x in xs), sorted(x for xs in come.values() for x in xs)
    more, pairs = _matched(old, new, lambda p, q: MOVE + 0.25 / (1 + agreement[p, q]) if agreement.get((p, q)) and _within(p) != _within(q) else FORBIDDEN)
    script += [("moved", p, q) for p, q in pairs.items()]
    script += [("removed", p, "") for p in old if p not in pairs] + [("added", "", q) for q in new if q not in pairs.values()]
    return cost + more + DELETE * (len(old) - len(pairs)) + INSERT * (len(new) - len(pairs)), sorted(script)


def _scripts(batches):
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            agreement = {(e["old"], e["new"]): float(e["n"]) for e in (r.agreement if r.agreement is not None else [])}
            before, after = list(r.before) if r.before is not None else [], list(r.after) if r.after is not None else []
            cost, script = edit_script(before, after, agreement)
            rows += [(r.feed, r.file_id, r.seq, cost, *s) for s in script]
        yield pd.DataFrame(rows, columns=["feed", "file_id", "seq", "distance", "change_kind", "old_field", "new_field"])


def edit_scripts(shapes: DataFrame, order: DataFrame, fields: DataFrame, cut=lambda df: df) -> DataFrame:
    """One row per step of the cheapest script between each file and the one before in its feed.

    A vanished and an appeared leaf agree when their values (and types) are equal on every summary that both files hold; the
    number of those values that are not null is their evidence. Two files without a common summary give none, so
    nothing between them is renamed or moved. If a file holds a summary several times, its last line counts. Files without
    a readable record have no fields.
    """
    pairs = order.where("prev_id is not null").select("feed", "file_id", "seq", "prev_id")
    now = fields.select("file_id", "path")
    before = pairs.select("file_id", "prev_id").join(now.select(F.col("file_id").alias("prev_id"), "path"), "prev_id").select("file_id", "path")
    after = pairs.select("file_id").join(now, "file_id")
    sides = before.withColumn("side", F.lit(1)).unionByName(after.withColumn("side", F.lit(2))).groupBy("file_id", "path").agg(F.sum("side").alias("side"))
    of = lambda *which: F.collect_list(F.when(F.col("side").isin(*which), F.col("path")))
    trees = sides.join(pairs, "file_id").groupBy("feed", "file_id", "seq", "prev_id").agg(of(1, 3).alias("before"), of(2, 3).alias("after"), of(1).alias("gone"), of(2).alias("come")).where((F.size("gone") > 0) | (F.size("come") > 0))
    trees = cut(trees)  # one row a pair of files whose paths differ
    asked = trees.where((F.size("gone") > 0) & (F.size("come") > 0)).select("file_id", "prev_id", "gone", "come")
    last = lambda rows: rows.groupBy("file_id", "summary_key").agg(F.max_by(F.struct("paths", "marks"), "line_no").alias("r"))
    keyed = shapes.where("summary_key is not null")
    # only records of files whose paths differ, and of the files before them, are brought together
    new = last(keyed.join(asked.select("file_id"), "file_id", "left_semi"))
    old = last(keyed.join(asked.select(F.col("prev_id").alias("file_id")).distinct(), "file_id", "left_semi"))
    both = asked.join(old.select(F.col("file_id").alias("prev_id"), "summary_key", F.col("r").alias("was")), "prev_id").join(new.withColumnRenamed("r", "now"), ["file_id", "summary_key"])
    cell = lambda side, paths, which: F.transform(paths, lambda p: F.struct(F.lit(which).alias("side"), p.alias("path"), F.get(f"{side}.marks", F.array_position(f"{side}.paths", p).cast("int") - 1).alias("mark")))
    cells = both.select("file_id", "summary_key", F.explode(F.concat(cell("was", "gone", 1), cell("now", "come", 2))).alias("c")).select("file_id", "summary_key", "c.*")
    salted = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "summary_key", "mark", F.col("mark").isNull()))
    signed = cells.groupBy("file_id", "side", "path").agg(salted(1).alias("s1"), salted(2).alias("s2"), F.count_if(F.col("mark") != 0).alias("n"))
    agreement = (
        signed.where("side = 1").select("file_id", "s1", "s2", F.col("path").alias("old"), "n")
        .join(signed.where("side = 2").select("file_id", "s1", "s2", F.col("path").alias("new")), ["file_id", "s1", "s2"])
        .groupBy("file_id").agg(F.collect_list(F.struct("old", "new", "n")).alias("agreement"))
    )
    rows = trees.join(agreement, "file_id", "left").select("feed", "file_id", "seq", "before", "after", "agreement")
    return spread(rows, "file_id").mapInPandas(_scripts, "feed string, file_id long, seq int, distance double, change_kind string, old_field string, new_field string")


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """Types of one feed's fields through its renames; pdf holds renames and the files where a type may have changed."""
    known: dict[str, str] = {}
    out = []
    rows = sorted(zip(pdf.seq.tolist(), pdf.step.tolist(), pdf.path.tolist(), pdf.file_id.tolist(), pdf.kind.tolist(), pdf.old_field.tolist()), key=lambda r: r[:3])
    for _, same in groupby(rows, key=lambda r: r[:2]):
        same = list(same)
        if same[0][1] == 0:  # all renames of a file happen at once
            moved = [(r[2], known.pop(r[5], None)) for r in same]
            for path, kind in moved:
                known.pop(path, None)
                if kind is not None:
                    known[path] = kind
        else:
            for _, _, path, file_id, kind, _ in same:
                if known.get(path, kind) != kind:
                    out.append((file_id, "retyped", path, path))
                known[path] = kind
    return pd.DataFrame(out, columns=["file_id", "change_kind", "old_field", "new_field"])


def retypings(scripts: DataFrame, order: DataFrame, fields: DataFrame) -> DataFrame:
    """Fields whose type differs from their last known one, followed through renames.

    Fields that are never renamed in their feed are told by a window over their own files. Of the others only files whose type
    differs from the last observed under that path, and the last before and the first after each rename of it, are
    followed in order; long runs of one type are thinned to their ends before.
    """
    seen = fields.where("kind is not null").join(order.select("file_id", "feed", "seq"), "file_id").select("feed", "file_id", "seq", "path", "kind")
    renames = scripts.where("change_kind = 'renamed'").select("feed", "file_id", "seq", "old_field", "new_field")
    touched = renames.select("feed", F.explode(F.array("old_field", "new_field")).alias("path"), "seq").groupBy("feed", "path").agg(F.sort_array(F.collect_set("seq")).alias("at"))
    by = Window.partitionBy("feed", "path").orderBy("seq")
    marked = (
        seen.join(touched, ["feed", "path"], "left")
        .withColumn("epoch", F.coalesce(F.size(F.filter("at", lambda x: x <= F.col("seq"))), F.lit(0)))
        .withColumn("was", F.lag("kind").over(by)).withColumn("was_epoch", F.lag("epoch").over(by))
    )
    plain = marked.where("at is null and was <> kind").select("file_id", F.lit("retyped").alias("change_kind"), F.col("path").alias("old_field"), F.col("path").alias("new_field"))
    thin = marked.where("at is not null and (was is null or was <> kind or epoch <> was_epoch)").select("feed", "file_id", "seq", F.lit(1).alias("step"), "path", "kind", F.lit("").alias("old_field"))
    events = thin.unionByName(renames.select("feed", "file_id", "seq", F.lit(0).alias("step"), F.col("new_field").alias("path"), F.lit(None).cast("string").alias("kind"), "old_field"))
    return plain.unionByName(spread(events, "feed").groupBy("feed").applyInPandas(_follow, "file_id long, change_kind string, old_field string, new_field string"))


def _prepared(records: DataFrame, files: DataFrame, cut) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(order of the files, fields of each file, scripts)"""
    shapes = cut(record_shapes(records))
    order = cut(file_order(files.where("feed is not null and file_id is not null")))
    fields = cut(file_fields(shapes))
    return order, fields, cut(edit_scripts(shapes, order, fields, cut))


def schema_scripts(records: DataFrame, files: DataFrame, cut=lambda df: df) -> DataFrame:
    """Every step of the cheapest script of each file, moves and renamed objects included, with its distance from the file before."""
    return _prepared(records, files, cut)[2]


def schema_changes(records: DataFrame, files: DataFrame, cut=lambda df: df) -> DataFrame:
    """added, removed, renamed and retyped fields of each file against the one before in its feed; a moved field is one removed and one added.

    cut: cuts lineage after the shapes and after the scripts, so that JSON is parsed once; the identity leaves the plan whole.
    Records of files that are not listed, and files without a feed, take no part. Empty tables give no rows.
    """
    order, fields, scripts = _prepared(records, files, cut)
    row = lambda kind, old, new: F.struct(F.lit(kind).alias("change_kind"), F.col(old).alias("old_field") if old else F.lit("").alias("old_field"), F.col(new).alias("new_field") if new else F.lit("").alias("new_field"))
    own = F.struct("change_kind", "old_field", "new_field")
    steps = scripts.where("change_kind <> 'renamed_node'").select("file_id", F.explode(F.when(F.col("change_kind") == "moved", F.array(row("removed", "old_field", None), row("added", None, "new_field"))).otherwise(F.array(own))).alias("c"))
    return steps.select("file_id", "c.*").unionByName(retypings(scripts, order, fields))


# Spark types of the kinds a field may have over all files.
SQL_TYPES = {"boolean": "boolean", "integer": "bigint", "decimal": "double", "string": "string", "array": "array<string>"}


def _typed(value: object, kind: str) -> object:
    """A value in the one type of its field; what does not fit is its JSON text in a string, and null elsewhere cannot occur."""
    if value is None:
        return None
    own = kind_of(value)
    if kind == "array":
        return [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in (value if own == "array" else [value])]
    if kind == "string":
        return value if own == "string" else json.dumps(value, ensure_ascii=False)
    return float(value) if kind == "decimal" else value


def unified_type(kinds: list[str]) -> str:
    """One type for a field: its only one; decimal for integers and decimals; array if any value is one; else string."""
    some = set(kinds)
    return some.pop() if len(some) == 1 else "array" if "array" in some else "decimal" if some == {"integer", "decimal"} else "string"


def one_name(renames: list[tuple[str, str, int]]) -> dict[str, str]:
    """Canonical name of each renamed path: paths tied by renames of any feed are one field, called what most files call it first.

    renames: (old path, new path, files) of all feeds; as many as there are pairs of names.
    """
    parent: dict[str, str] = {}
    weight: Counter = Counter()

    def top(p: str) -> str:
        while parent.setdefault(p, p) != p:
            p = parent[p]
        return p

    for old, new, n in renames:
        weight[old] += n
        parent[top(old)] = top(new)
    groups: dict[str, list[str]] = defaultdict(list)
    for p in parent:
        groups[top(p)].append(p)
    return {p: min(ps, key=lambda x: (-weight[x], x)) for ps in groups.values() for p in ps}


def unified_records(records: DataFrame, files: DataFrame, cut=lambda df: df, most_columns: int = MOST_COLUMNS) -> DataFrame:
    """One typed table of all records of all feeds: record_id, file_id, feed, one column per field (dots as __, prefix f__), and `other`.

    A field goes by one name in all feeds: names tied by a rename in any feed are one, and Substantive's finding is so found under
    whatever name. A column has one type over all files (see unified_type). If a record has two fields of one canonical name, the
    one whose own path it is takes the column and the other goes to `other`, a map from path to JSON text, as do
    fields beyond the `most_columns` of most files. Lines that are no JSON object are left out. The driver gets the distinct field
    names and renamed pairs of names, not records.
    """
    order, fields, scripts = _prepared(records, files, cut)
    renamed = scripts.where("change_kind = 'renamed'").groupBy("old_field", "new_field").agg(F.count("*").alias("n")).orderBy("old_field", "new_field").collect()
    name = one_name([tuple(r) for r in renamed])
    kinds: dict[str, set] = defaultdict(set)
    held: Counter = Counter()
    for r in fields.groupBy("path").agg(F.collect_set("kind").alias("kinds"), F.count("*").alias("n")).collect():
        kinds[name.get(r.path, r.path)] |= set(r.kinds)
        held[name.get(r.path, r.path)] += r.n
    wide = sorted(sorted(held, key=lambda f: (-held[f], f))[:most_columns])
    types = {f: unified_type(sorted(kinds[f])) if kinds[f] else "string" for f in wide}
    label = dict(zip(wide, _labels(wide)))
    fixed = [("record_id", pa.int64()), ("file_id", pa.int64()), ("feed", pa.string())]
    arrow = {"boolean": pa.bool_(), "integer": pa.int64(), "decimal": pa.float64(), "string": pa.string(), "array": pa.list_(pa.string())}

    def run(batches):
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in (*(c for c, _ in fixed), *wide, "")}
            for record_id, file_id, feed, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (obj := parsed(text)) is None:
                    continue
                leaves = dict(leaves_of(obj))
                row, other = {}, {}
                for path in sorted(leaves, key=lambda p: (name.get(p, p) != p, p)):
                    field = name.get(path, path)
                    if field in types and field not in row:
                        row[field] = _typed(leaves[path], types[field])
                    else:
                        other[path] = json.dumps(leaves[path], ensure_ascii=False)
                for c, v in zip((c for c, _ in fixed), (record_id, file_id, feed)):
                    cols[c].append(v)
                for f in wide:
                    cols[f].append(row.get(f))
                cols[""].append(list(other.items()))
            arrays = [pa.array(cols[c], t) for c, t in fixed] + [pa.array(cols[f], arrow[types[f]]) for f in wide] + [pa.array(cols[""], pa.map_(pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(c for c, _ in fixed), *(label[f] for f in wide), "other"])

    schema = ", ".join(["record_id long", "file_id long", "feed string", *(f"`{label[f]}` {SQL_TYPES[types[f]]}" for f in wide), "other map<string,string>"])
    rows = records.select("record_id", "file_id", "raw_json").join(order.select("file_id", "feed"), "file_id", "left").select("record_id", "file_id", "feed", "raw_json")
    return rows.mapInArrow(run, schema)


def _labels(fields: list[str]) -> list[str]:
    """Column names of fields, distinct whatever the case of letters."""
    out: list[str] = []
    taken: Counter = Counter()
    for f in fields:
        plain = "f__" + re.sub(r"[^\w]", "_", f.replace(".", "__"))
        taken[plain.lower()] += 1
        out.append(plain if taken[plain.lower()] == 1 else f"{plain}__{taken[plain.lower()]}")
    return out
