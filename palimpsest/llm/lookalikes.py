"""One consistent form for texts that look the same (problem 2).

Runs of text between plain white space are the values. Those holding a character outside plain Latin text are reduced to
their distinct values, and letters and signs are mapped to the plain ones they look like. Values so mapped are grouped in SQL
under Spark's accent-sensitive Unicode collation, which brings together accents stored apart or in one, in any order, and
leaves out what cannot be seen. Each class takes as canonical member the one that its map leaves alone and that has the fewest
characters outside plain text (ties by composed form, then code point order), and every other value of the class is rewritten to it. One mapped
value of each class is written out in composed form and is a member too, so that a class has a plain one even where none
occurs in the corpus.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other alphabets beside the Latin letter of the same look.
CYRILLIC = dict(zip("аеорсухіјѕԁһԛԝӏкАВЕЗКМНОРСТУХІЈЅԌԚԜ", "aeopcyxijsdhqwlkAB" + "E3KMHOPCTYXIJSGQW"))
GREEK = dict(zip("οαινρυχγκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oaivpuxykABEZHIKMNOPTYX"))
ARMENIAN = dict(zip("оսհօոցԼՕՏ", "ouhongLOS"))
TO_LATIN = {"CYRILLIC": CYRILLIC, "GREEK": GREEK, "ARMENIAN": ARMENIAN, "LATIN": {}}
LOOKALIKE = {**ARMENIAN, **GREEK, **CYRILLIC}
FROM_LATIN = {script: {v: k for k, v in reversed(pairs.items()) if v.isalpha()} for script, pairs in TO_LATIN.items()}
TIE = "⁀"  # stands before joiners and selectors that belong to what is seen; the collation does not ignore it
# Characters that cannot be seen.
INVISIBLE = frozenset("­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩ㅤ﻿ﾠ")
# Java and Python: a character that plain Latin text does not hold.
ODD = r"[^\x00-\x7F¡-¬®-ıĴ-ňŊ-žƀ-ǃǍ-ǰǴ-ɏ‐-‧‰-›€™]"
VALUE = rf"(?<![^ \n\t\r])[^ \n\t\r]*?{ODD}[^ \n\t\r]*"  # starts only where a run starts, so that long runs take linear time
_ODD = re.compile(ODD)


@lru_cache(maxsize=65536)
def _variant(ch: str) -> str | None:
    """Plain letters, digits or signs of the same look for a variant form; None for any other character."""
    tag, cat = unicodedata.decomposition(ch).split(" ")[0], unicodedata.category(ch)
    if cat == "Zs" and ch != " ":
        return " "
    if tag in ("<wide>", "<narrow>", "<font>") or (tag == "<compat>" and cat in ("Ll", "Lu", "Lt", "Lo", "Nl") and ch != "µ"):
        return unicodedata.normalize("NFKC", ch)
    return None


@lru_cache(maxsize=65536)
def _script(ch: str) -> str:
    if not ch.isalpha():
        return ""
    name = unicodedata.name(ch, "").split(" ")[0]
    return "CJK" if name in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "IDEOGRAPHIC") else name


def _joins(text: str, i: int) -> bool:
    """Whether the unseen character at i belongs to what is seen: within emoji, or between letters of a script that uses joiners."""
    if i == 0:
        return False
    a, ch, b = text[i - 1], text[i], text[i + 1 : i + 2]
    if ch in "\ufe0e\ufe0f" or "\U000e0020" <= ch <= "\U000e007f":
        return True
    if not b:
        return False
    if ch == "\u200d" and (a == "\ufe0f" or unicodedata.category(a) in ("So", "Sk")) and unicodedata.category(b) == "So":
        return True
    shaped = lambda c: unicodedata.category(c)[0] in "LM" and not c.isascii() and _script(c) not in ("LATIN", "CYRILLIC", "GREEK", "FULLWIDTH", "MATHEMATICAL", "")
    return ch in "\u200c\u200d" and shaped(a) and shaped(b)


def _unmix(word: str) -> str:
    """A word of one alphabet: look-alike letters of another take the form of the word's own, which is the one that some of its letters
    are found in alone; Latin if that is none or several."""
    of = {c: _script(c) for c in word}
    scripts = set(of.values()) & TO_LATIN.keys()
    if len(scripts) < 2:
        return word
    alone = {of[c] for c in word if of[c] in scripts - {"LATIN"} and c not in TO_LATIN[of[c]]}
    own = alone.pop() if len(alone) == 1 else "LATIN"
    back = FROM_LATIN[own]
    plain = {c: TO_LATIN[of[c]].get(c, c) if of[c] in scripts else c for c in of}
    if own != "LATIN":
        if any(of[c] in scripts - {own} and plain[c] not in back for c in word):
            own = "LATIN" if "LATIN" in scripts else own  # it has letters of its own in two alphabets
        else:
            return "".join(c if of[c] in (own, "") or of[c] not in scripts else back[plain[c]] for c in word)
    return "".join(plain[c] for c in word) if "LATIN" in scripts else word


#: Letters of a word with the accents and unseen characters among them.
_WORD = re.compile(rf"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f{''.join(sorted(INVISIBLE))}])*")


@lru_cache(maxsize=100_000)
def look_alike(value: str) -> str:
    """A value in plain letters, digits, signs and spaces of the same look, one alphabet a word. Accents and unseen characters stay as they
    are; those that belong to what is seen are tied."""
    if not _ODD.search(value):
        return value
    east = any(_script(c) == "CJK" for c in value)
    out = []
    for i, ch in enumerate(value):
        if not ch.isascii() and (ch in INVISIBLE or ch in "\ufe0e\ufe0f" or ch >= "\U000e0020"):
            out.append(TIE + ch if _joins(value, i) else ch)
            continue
        form = None if ch.isascii() else _variant(ch)
        # wide signs and the wide space are the usual form beside East Asian letters
        if form is not None and east and unicodedata.east_asian_width(ch) == "F" and not ch.isalnum():
            form = None
        out.append(ch if form is None else form)
    return _WORD.sub(lambda m: _unmix(m.group()), "".join(out))


def visible(mapped: str) -> str:
    """A mapped value in composed form without characters that cannot be seen, and without ties."""
    out = []
    for i, ch in enumerate(mapped):
        if ch == TIE or ch in INVISIBLE and not (i and mapped[i - 1] == TIE):
            continue
        out.append(ch)
    return unicodedata.normalize("NFC", "".join(out))


def looks_like(value: str) -> str:
    """What a text looks like: no hidden characters, plain spaces, plain letters and digits, composed accents, one alphabet a word."""
    return visible(look_alike(value)) if _ODD.search(value) else value


@F.pandas_udf(T.StringType())
def look_alike_map(values: pd.Series) -> pd.Series:
    return values.map(look_alike)


@F.pandas_udf(T.StringType())
def written_out(mapped: pd.Series) -> pd.Series:
    return mapped.map(visible)


def candidates(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, value) of every run that holds a character outside plain text, once per id."""
    return texts.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(text_col, F.lit(VALUE), F.lit(0)))).alias("value"))


def canonical_forms(cands: DataFrame) -> DataFrame:
    """value -> canonical, for values that are not canonical themselves."""
    spark = cands.sparkSession
    values = cands.groupBy("value").agg(F.count("*").alias("n")).select("value", look_alike_map("value").alias("mapped"))
    classes = spark.sql(
        f"""
        SELECT mapped COLLATE UNICODE AS class_key, min(mapped) AS sample,
          min(struct(replace(mapped, '{TIE}', '') <> value AS mapped_away, 2 * regexp_count(value, r'{ODD}') + 1 AS odd, value AS member)) AS best
        FROM {{values}} GROUP BY mapped COLLATE UNICODE
        """,
        values=values,
    ).withColumn("plain", written_out("sample"))
    return spark.sql(
        f"""
        WITH chosen AS (SELECT class_key, least(best, struct(false AS mapped_away, 2 * regexp_count(plain, r'{ODD}') AS odd, plain AS member)).member AS canonical FROM {{classes}})
        SELECT v.value, c.canonical FROM {{values}} v JOIN chosen c ON v.mapped COLLATE UNICODE = c.class_key WHERE c.canonical <> v.value
        """,
        values=values,
        classes=classes,
    )


def affected(texts: DataFrame, id_col: str = "chunk_id", text_col: str = "text", cut=lambda df: df) -> DataFrame:
    """(id, value, canonical) of each run to be rewritten.

    Null and empty texts and texts in plain Latin characters hold none; nor do whole words of another script, accented
    letters stored as one character, typographic quotes and dashes, emoji with joiners, tabs, trademark, superscript,
    fraction and numero signs. Other columns are ignored. An id that occurs in several rows has the runs of all of them.
    """
    cands = cut(candidates(texts, id_col, text_col))
    return cands.join(canonical_forms(cands), "value").select(F.col("id").alias(id_col), "value", "canonical")


def one_form(texts: DataFrame, id_col: str = "chunk_id", text_col: str = "text", cut=lambda df: df) -> DataFrame:
    """(id, text) with every run in its canonical form; texts without affected runs come out as they are, null as null."""
    swaps = affected(texts, id_col, text_col, cut).groupBy(id_col).agg(F.map_from_entries(F.collect_set(F.struct("value", "canonical"))).alias("swap"))
    runs = F.split(F.col(text_col), r"(?<=[ \n\t\r])|(?=[ \n\t\r])")
    new = F.array_join(F.transform(runs, lambda r: F.coalesce(F.try_element_at(F.col("swap"), r), r)), "")
    return texts.select(id_col, text_col).join(swaps, id_col, "left").select(id_col, F.when(F.col("swap").isNull(), F.col(text_col)).otherwise(new).alias(text_col))
