"""Lines repeated across one source's documents (problem 7).

A source's documents are sequences of line identifiers. Its suffix array (every position's following identifiers in order) is
built by a range-partitioned sort on (source, suffix, document), so that neither a large source nor a hot line meets in one
task. Suffixes are at first compared over `DEPTH` identifiers, and wherever that many lines still repeat, again over four times
as many, until no block goes on. Common prefixes of neighbours give the repeated blocks; runs within a partition count their
documents there, and only runs that touch a partition's edge are counted across partitions. Every position takes the longest
block that spans enough documents of the source; the positions of those blocks that no other covers are what is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEPTH = 4  # identifiers of a suffix compared in the first round
BROADCAST_ROWS = 200_000  # first lines of blocks, at some 100 bytes each


def line_ids(text_col: str):
    """Array of line identifiers of a text: lines agree after white space is trimmed and collapsed, case is folded and each
    run of digits 0-9 counts as one; a blank line is null."""
    flat = F.regexp_replace(F.regexp_replace(text_col, r"[\s\x1c-\x1f\x85\p{Z}&&[^\n]]+", " "), r"[0-9]+", "0")
    lines = F.split(F.lower(F.upper(flat)), "\n")
    return F.transform(lines, lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def sequences(texts: DataFrame, source: str, document: str, id_col: str, text_col: str) -> DataFrame:
    """(source, document, id, ids) of each text; rows of null source or document or text take no part."""
    rows = texts.where(F.col(source).isNotNull() & F.col(document).isNotNull() & F.col(text_col).isNotNull())
    return rows.select(F.col(source).alias("source"), F.col(document).alias("document"), F.col(id_col).alias("id"), line_ids(text_col).alias("ids"))


def _until_blank(tail):
    gap = F.array_position(F.transform(tail, lambda x: x.isNull()), True).cast("int")
    return F.when(gap > 0, F.slice(tail, 1, gap - 1)).otherwise(tail)


def suffixes(seqs: DataFrame, depth: int, heads: DataFrame | None = None, known: int = 0) -> DataFrame:
    """Distinct (source, suffix, document): the up to `depth` identifiers from each position, ending before a blank line.

    heads: (source, hash) of the blocks of `known` lines that positions must begin with.
    """
    at = seqs.select("source", "document", "ids", F.explode(F.sequence(F.lit(1), F.size("ids"))).alias("i")).where(F.get("ids", F.col("i") - 1).isNotNull())
    rows = at.select("source", _until_blank(F.slice("ids", F.col("i"), depth)).alias("suffix"), F.xxhash64("document").alias("document"))
    if heads is not None:
        rows = rows.where(F.size("suffix") > known).withColumn("hash", F.xxhash64(F.slice("suffix", 1, known))).join(heads, ["source", "hash"], "left_semi").drop("hash")
    return rows.distinct()


def _runs(above: int, depth: int, least: int):
    """Blocks of more than `above` and at most `depth` lines of one sorted partition: (source, block, document or null, number of
    documents). A block is given only where not all of its suffixes go on alike."""

    def common(same_source: np.ndarray, grid: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Longest common prefix of each row with the one before."""
        lcp = np.zeros(len(length), dtype=np.int64)
        if len(length) > 1:
            eq = (grid[1:] == grid[:-1]) & (np.arange(depth) < np.minimum(length[1:], length[:-1])[:, None]) & same_source[:, None]
            lcp[1:] = np.cumprod(eq, axis=1).sum(axis=1)
        return lcp

    def emit(source: list, grid: np.ndarray, length: np.ndarray, doc: np.ndarray, first: bool, last: bool):
        """Repeated blocks of a stretch of the suffix array that no run leaves except at the partition's edges."""
        n = len(length)
        src = np.asarray(source, dtype=object)
        lcp = common(src[1:] == src[:-1], grid, length)
        longer: set[tuple[int, int]] = set()  # runs of which all suffixes go on in one block
        out: tuple[list, list, list, list] = ([], [], [], [])
        for d in range(depth, above, -1):
            start = np.flatnonzero(lcp < d)
            end = np.append(start[1:], n)
            edge = ((start == 0) & first) | ((end == n) & last)
            for k in np.flatnonzero((length[start] >= d) & ((end - start >= least) | edge)):
                a, b = start[k], end[k]
                docs = np.unique(doc[a:b])
                if not edge[k] and (len(docs) < least or (a, b) in longer):
                    continue
                listed = docs.tolist() if edge[k] else [None]
                for field, values in zip(out, ([src[a]] * len(listed), [grid[a, :d].tolist()] * len(listed), listed, [1 if edge[k] else len(docs)] * len(listed))):
                    field.extend(values)
                longer.add((a, b))
        return out

    def parts(batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        suffix = t.column("suffix").chunk(0)
        length = np.diff(suffix.offsets.to_numpy())
        flat = suffix.flatten().to_numpy()
        grid = np.zeros((len(length), depth), dtype=np.int64)
        grid[np.repeat(np.arange(len(length)), length), np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
        return t.column("source").to_pylist(), grid, length, t.column("document").to_numpy()

    def head(b: pa.RecordBatch, row: int) -> tuple:
        return b.column(0)[row].as_py(), b.column(1)[row][0].as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the first line that may go on
        first = True

        def batch(x):
            return pa.RecordBatch.from_arrays([pa.array(x[0], pa.string()), pa.array(x[1], pa.list_(pa.int64())), pa.array(x[2], pa.int64()), pa.array(x[3], pa.int64())], names=["source", "block", "document", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            last = head(b, b.num_rows - 1)
            low, high = 0, b.num_rows - 1  # where the run of the last first line begins
            while low < high:
                mid = (low + high) // 2
                low, high = (low, mid) if head(b, mid) == last else (mid + 1, high)
            if low == 0 and (not held or head(held[-1], held[-1].num_rows - 1) == last):
                held.append(b)
                continue
            done = [*held, b.slice(0, low)] if low else held
            yield batch(emit(*parts(done), first, False))
            first, held = False, [b.slice(low)]
        if held:
            yield batch(emit(*parts(held), first, True))

    return run


def repeated_blocks(seqs: DataFrame, pages: DataFrame, depth: int = DEPTH, min_documents: int = 4, min_share: float = 0.3, cut=lambda df: df) -> DataFrame:
    """(source, block, n_documents, n_source): blocks, of any number of lines, in at least `min_documents` and `min_share` of the
    source's documents, where not all of their occurrences go on alike.

    pages: the (source, document) of all rows, whether or not they hold text; a document counts once.
    """
    totals = pages.distinct().groupBy("source").agg(F.count("*").alias("n_source"))
    out, above, heads = [], 0, None
    while True:
        arr = cut(suffixes(seqs, depth, heads, above))
        order = arr.repartitionByRange(F.col("source"), F.col("suffix"), F.col("document")).sortWithinPartitions("source", "suffix", "document")
        runs = order.mapInArrow(_runs(above, depth, min_documents), "source string, block array<bigint>, document bigint, n bigint")
        # a run at an edge lists its documents, which may recur beyond the edge
        whole = runs.groupBy("source", "block", "document").agg(F.max("n").alias("n")).groupBy("source", "block").agg(F.sum("n").alias("n_documents"))
        some = whole.where(F.col("n_documents") >= min_documents).join(totals, "source").where(F.col("n_documents") >= F.ceil(F.round(F.col("n_source") * F.lit(min_share), 6)))
        out.append(cut(some))
        going = out[-1].where(F.size("block") == depth).select("source", F.xxhash64("block").alias("hash"))
        if going.isEmpty():
            return reduce(DataFrame.unionAll, out)
        above, heads, depth = depth, going, 4 * depth


def deleted_blocks(
    texts: DataFrame, source: str = "company", document: str = "policy", id_col: str = "chunk_id", text_col: str = "text",
    depth: int = DEPTH, min_documents: int = 4, min_share: float = 0.3, cut=lambda df: df,
) -> DataFrame:
    """(id, line_no, lines): where the longest repeated blocks stand that no other repeated block of their text covers.

    Rows of null source, document or text hold none, and a null document counts as no document. Blank lines are in no block.
    Repeated rows count once as documents and are each reported.
    """
    seqs = cut(sequences(texts, source, document, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    pages = texts.select(F.col(source).alias("source"), F.col(document).alias("document")).dropna()
    blocks = repeated_blocks(seqs, pages, depth, min_documents, min_share, cut)
    first = blocks.groupBy("source", F.col("block")[0].alias("line")).agg(F.collect_set(F.struct(F.size("block").alias("d"), F.xxhash64("block").alias("h"))).alias("known"))
    first = cut(first.withColumn("most", F.array_max(F.transform("known", lambda k: k["d"]))))
    longest = first.agg(F.max("most")).first()[0] or 1
    first = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    at = seqs.select("source", "id", "row", F.explode(F.transform("ids", lambda x, i: F.struct(i.alias("line_no"), x.alias("line"), F.slice("ids", i + 1, F.lit(longest)).alias("tail")))).alias("p"))
    at = at.select("source", "id", "row", "p.line_no", "p.line", "p.tail").where("line is not null").join(first, ["source", "line"])
    fits = F.filter("known", lambda k: (k["d"] <= F.size("tail")) & (F.xxhash64(F.slice("tail", F.lit(1), k["d"])) == k["h"]))
    found = at.select("id", "row", "line_no", F.array_max(F.transform(fits, lambda k: k["d"])).alias("lines")).where("lines > 0")
    by = Window.partitionBy("row").orderBy("line_no")
    before = F.lag(F.col("line_no") + F.col("lines")).over(by)
    # ends of blocks never fall back from line to line, so one look at the line before tells whether it covers this one
    return found.withColumn("before", before).where(F.col("before").isNull() | (F.col("before") < F.col("line_no") + F.col("lines"))).select(F.col("id").alias(id_col), "row", "line_no", "lines")


def lines_to_delete(texts: DataFrame, source: str = "company", document: str = "policy", id_col: str = "chunk_id", text_col: str = "text", **how) -> DataFrame:
    """(id, line_no) of every line within a repeated block of its source, see deleted_blocks."""
    blocks = deleted_blocks(texts, source, document, id_col, text_col, **how)
    by = Window.partitionBy("row").orderBy("line_no")
    ends = F.max(F.col("line_no") + F.col("lines")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    # blocks may overlap: each gives the lines beyond those before it
    own = blocks.withColumn("from", F.greatest("line_no", F.coalesce(ends, F.lit(0))))
    return own.where(F.col("from") < F.col("line_no") + F.col("lines")).select(id_col, F.explode(F.sequence("from", F.col("line_no") + F.col("lines") - 1)).alias("line_no"))


def without_lines(texts: DataFrame, found: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """(id, text) of every row, each text without the lines found in it; null stays null."""
    gone = found.groupBy(id_col).agg(F.collect_set("line_no").alias("gone"))
    kept = F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("gone", i))
    return texts.select(id_col, text_col).join(gone, id_col, "left").select(id_col, F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(text_col))
