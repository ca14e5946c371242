"""Opcodes of sequence differences. Only the matching itself is Python (the standard library's matcher, in Arrow batches); lines and
characters are cut out of the texts by column expressions."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.udfs import arrow_udf

#: Half-open ranges of both sides, and whether their lines have to be compared again for their likeness.
OPCODE = "struct<tag:string,i1:int,i2:int,j1:int,j2:int>"
LINE_OPCODE = "struct<tag:string,i1:int,i2:int,j1:int,j2:int,sim:double>"
# Fixed value: where Python's str.splitlines() ends a line.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
AUTOJUNK_FROM = 200  # length from which the matcher takes frequent elements for junk


def opcodes(a, b, junk=None) -> list[tuple[str, int, int, int, int]]:
    return SequenceMatcher(junk, a, b).get_opcodes()


def likeness(tag: str, left: list[str], right: list[str]) -> float:
    """Ratio of two ranges. Only a replaced range that shares a line (blank, or frequent in a long text) needs the matcher."""
    if tag == "replace":
        return 0.0 if set(left).isdisjoint(right) else SequenceMatcher(str.isspace, left, right).ratio()
    return float(tag == "equal")


@arrow_udf(f"array<{LINE_OPCODE}>")
def line_opcodes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Opcodes of two arrays of lines, blank lines being junk; null where either is null."""

    def one(x, y):
        if x is None or y is None:
            return None
        x, y = list(x), list(y)
        return [(tag, i1, i2, j1, j2, likeness(tag, x[i1:i2], y[j1:j2])) for tag, i1, i2, j1, j2 in opcodes(x, y, str.isspace)]

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=object)


@arrow_udf(f"array<{OPCODE}>")
def char_opcodes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Character opcodes of two texts; null where either is null (a pair that needs none)."""
    return pd.Series([None if x is None or y is None else opcodes(x, y) for x, y in zip(a, b)], dtype=object)


def whole(n: Column) -> Column:
    """The opcodes of two texts of n characters that are equal."""
    zero = F.lit(0)
    return F.when(n > 0, F.array(F.struct(F.lit("equal").alias("tag"), zero.alias("i1"), n.alias("i2"), zero.alias("j1"), n.alias("j2")))).otherwise(F.array().cast(f"array<{OPCODE}>"))


def cut_lines(lines: Column, start: Column, end: Column) -> Column:
    return F.slice(lines, start + F.lit(1), end - start)


def cut_text(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + F.lit(1), end - start)


def split_lines(text: Column) -> Column:
    """Lines of a text without their ends; a last end begins no further line."""
    parts = F.split(text, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def marked_up(text: Column, ops: Column, start: str, end: str, css: str) -> Column:
    """A text with what differs in spans."""

    def one(o: Column) -> Column:
        piece = cut_text(text, o[start], o[end])
        return F.when((o["tag"] == "equal") | (piece == ""), piece).otherwise(F.concat(F.lit(f'<span class="{css}">'), piece, F.lit("</span>")))

    return F.array_join(F.transform(ops, one), "")
