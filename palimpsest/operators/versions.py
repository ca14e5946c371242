"""Versions of a document and the differences between neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.diffs import char_opcodes, cut_lines, cut_text, line_opcodes, marked_up, split_lines, whole

KEY = ["company", "policy"]


def documents(chunks: DataFrame) -> DataFrame:
    """One row a version: its chunk texts in order, the latest delivery of each chunk counting; nulls are left out."""
    last = chunks.dropna(subset=[*KEY, "version_ts", "chunk_idx"]).groupBy(*KEY, "version_ts", "chunk_idx").agg(F.max_by("text", F.struct("loaded_at", "chunk_id")).alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("chunk_idx", "text")))
    return last.groupBy(*KEY, "version_ts").agg(F.filter(F.transform(parts, lambda p: p["text"]), lambda t: t.isNotNull()).alias("lines"))


def neighbours(versions: DataFrame) -> DataFrame:
    """Each version with the one before and the one after it in its document (by version_ts as text).

    Documents are told apart by (company, policy), not by a common beginning of their names.
    """
    by = Window.partitionBy(*KEY).orderBy("version_ts")
    return versions.select(*KEY, "version_ts", F.lag("version_ts").over(by).alias("before_ts"), F.lead("version_ts").over(by).alias("after_ts"))


def pairs(docs: DataFrame) -> DataFrame:
    """Neighbouring versions of a document with the lines of both and whether they differ."""
    by = Window.partitionBy(*KEY).orderBy("version_ts")
    both = docs.select(*KEY, "version_ts", F.lag("version_ts").over(by).alias("before_ts"), F.lag("lines").over(by).alias("before_lines"), F.col("lines").alias("after_lines"))
    return both.where("before_ts is not null").withColumn("has_diff", F.col("before_lines") != F.col("after_lines"))


def _line_opcodes(p: DataFrame) -> DataFrame:
    """Pairs with the opcodes `ops` of their lines. The matcher gets nothing to do for equal pairs: they are one 'equal', or nothing."""
    n = F.size("before_lines")
    same = F.filter(F.array(F.struct(F.lit("equal").alias("tag"), F.lit(0).alias("i1"), n.alias("i2"), F.lit(0).alias("j1"), n.alias("j2"), F.lit(1.0).cast("double").alias("sim"))), lambda o: o["i2"] > 0)
    asked = lambda c: F.when(F.col("has_diff"), F.col(c))
    return p.withColumn("ops", F.coalesce(line_opcodes(asked("before_lines"), asked("after_lines")), same))


def raw_diffs(docs: DataFrame) -> DataFrame:
    """Line opcodes of each pair of neighbours with the lines of both sides and their likeness `sim`."""
    before, after = F.col("before_lines"), F.col("after_lines")
    full = lambda o: F.struct(*[o[c].alias(c) for c in ("tag", "i1", "i2", "j1", "j2")], cut_lines(before, o["i1"], o["i2"]).alias("before"), cut_lines(after, o["j1"], o["j2"]).alias("after"), o["sim"].alias("sim"))
    return _line_opcodes(pairs(docs)).withColumn("diffs", F.transform("ops", full)).drop("ops")


def span_diffs(docs: DataFrame) -> DataFrame:
    """Character opcodes of the lines that face each other within each line opcode (equal ones too), one row each; `line_ord` numbers
    the facing lines of a pair of versions, `ord` the opcodes of two lines."""
    where = ("idx", "i1", "i2", "j1", "j2")
    sides = lambda o, i: F.struct(i.alias("idx"), *[o[c].alias(c) for c in where[1:]], _lines_of("before_lines", o["i1"], o["i2"]).alias("x"), _lines_of("after_lines", o["j1"], o["j2"]).alias("y"))
    faced = F.flatten(F.transform(F.transform("ops", sides), _faced))
    rows = _line_opcodes(pairs(docs).where("has_diff")).select(*KEY, "version_ts", "before_ts", F.posexplode(faced).alias("line_ord", "f")).select(*KEY, "version_ts", "before_ts", "line_ord", "f.*")
    asked = lambda side: F.when(F.col("x") != F.col("y"), F.col(side))
    coded = rows.withColumn("chars", F.coalesce(char_opcodes(asked("x"), asked("y")), whole(F.length("x"))))
    out = coded.select(*KEY, "version_ts", "before_ts", "line_ord", *where, "x", "y", F.posexplode("chars").alias("ord", "o"))
    ranges = [F.col(f"o.{c}").alias(d) for c, d in (("i1", "ii1"), ("i2", "ii2"), ("j1", "jj1"), ("j2", "jj2"))]
    return out.select(*KEY, "version_ts", "before_ts", "line_ord", "ord", "o.tag", *where, *ranges, cut_text(F.col("x"), F.col("o.i1"), F.col("o.i2")).alias("before"), cut_text(F.col("y"), F.col("o.j1"), F.col("o.j2")).alias("after"))


def _lines_of(side: str, start, end):
    return split_lines(F.array_join(cut_lines(F.col(side), start, end), "\n"))


def _faced(o):
    """The lines of an opcode's two sides by position; the shorter side is filled up with empty lines."""
    most = F.greatest(F.size(o["x"]), F.size(o["y"]))
    at = lambda side, k: F.coalesce(F.get(o[side], k), F.lit(""))
    pair = lambda _, k: F.struct(*[o[c].alias(c) for c in ("idx", "i1", "i2", "j1", "j2")], at("x", k).alias("x"), at("y", k).alias("y"))
    return F.transform(F.array_repeat(F.lit(0), most), pair)


def clean_diffs(raw: DataFrame) -> DataFrame:
    """Sections that are not equal, lines joined by a space, with the number they had among all opcodes."""
    numbered = F.transform("diffs", lambda d, i: F.struct(i.alias("index"), d["tag"].alias("tag"), F.array_join(d["before"], " ").alias("before"), F.array_join(d["after"], " ").alias("after")))
    return raw.select(*KEY, "version_ts", F.explode(F.filter(numbered, lambda d: d["tag"] != "equal")).alias("d")).select(*KEY, "version_ts", "d.index", "d.before", "d.after")


def manifest(versions: DataFrame) -> DataFrame:
    """Of each document the map of a version's file to the file before it."""
    file = lambda c: F.concat(c, F.lit(".json"))
    rows = neighbours(versions).where("before_ts is not null")
    return rows.groupBy(*KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(file(F.col("version_ts")).alias("k"), file(F.col("before_ts")).alias("v"))))).alias("manifest"))


def highlighted(raw: DataFrame) -> DataFrame:
    """Sections that are not equal, lines joined by newlines, with what differs in spans."""
    numbered = F.transform("diffs", lambda d, i: F.struct(i.alias("index"), d["tag"].alias("tag"), F.array_join(d["before"], "\n").alias("before"), F.array_join(d["after"], "\n").alias("after")))
    rows = raw.select(*KEY, "version_ts", F.explode(F.filter(numbered, lambda d: d["tag"] != "equal")).alias("d")).select(*KEY, "version_ts", "d.index", "d.before", "d.after")
    ops = rows.withColumn("ops", char_opcodes("before", "after"))
    side = lambda c, i, j, css: marked_up(F.col(c), F.col("ops"), i, j, css).alias(f"{c}_html")
    return ops.select(*KEY, "version_ts", "index", side("before", "i1", "i2", "diff_sub"), side("after", "j1", "j2", "diff_add"))


def template_map(marked: DataFrame) -> DataFrame:
    """Of each version the map from section number, as text, to its highlighted sides."""
    entry = F.struct(F.col("index").cast("string").alias("k"), F.struct(F.col("before_html").alias("before"), F.col("after_html").alias("after")).alias("v"))
    return marked.groupBy(*KEY, "version_ts").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("sections"))
