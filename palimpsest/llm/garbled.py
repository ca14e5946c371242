"""Text decoded with the wrong character encoding (problem 10).

Clauses and words that are equal once characters outside ASCII are stripped are near-twins. A transformation (bytes of one
encoding read in another) that turns the runs of other characters of one twin into the other's is inferred: the runs of
every clause and word are undone by every transformation, and what comes out is looked up among all clauses and words. The
most frequent twin is also aligned run by run with the others, so that clauses garbled only in places tell as well. The
transformations so learned are applied to every word of the corpus. A repair holds if the corpus knows the repaired word
better than the garbled one, or, for bytes of UTF-8, if it decodes throughout into characters the corpus uses. The corpus
is its distinct texts, so that copies of one garbled text do not outvote the clean ones. Decoding with losses (replacement
signs, stray control codes) is such a transformation too, learned from twins of words so marked; what has no twin stays unrestored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Encodings that text is read in by mistake, and those of one byte a character it may have been written in.
READ = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_15", "iso8859_2", "iso8859_5", "mac_cyrillic", "cp1254", "cp1257")
BYTES = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_2", "iso8859_5", "iso8859_15")
MULTIBYTE = [(r, "utf-8", n) for r in READ for n in (1, 2)]
SINGLE = [(r, b, 1) for r in (*BYTES, "latin-1") for b in BYTES if r != b]
TRANSFORMATIONS = {f"{r}<-{b}" + "x2" * (n == 2): (r, b, n) for r, b, n in (*MULTIBYTE, *SINGLE)}

_RUN = re.compile(r"[^\x00-\x7f]+")
LOST = r"[\x{80}-\x{9f}\x{fffd}]"
_LOST = re.compile("[\x80-\x9f�]")
_SIGN = re.compile(r"[^\w\s‘’‚“”„‹›«»–—…]|[ªºµ_]")  # a sign that right words do not hold beside their letters
WORD = r"(?<![^ \n\t\r])[^ \n\t\r]*?[^\x00-\x7F][^ \n\t\r]*"  # starts only where a run starts, so that long runs take linear time
MIN_SUPPORT, MIN_SKELETON, STRONG, EVIDENT = 2, 4, 4, 20


@lru_cache(maxsize=32)
def _table(codec: str) -> dict[str, int]:
    """Characters of a one-byte encoding by byte; a byte without a character stands for the control code of its number."""
    out = {}
    for b in range(128, 256):
        out.setdefault(chr(b), b)
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            pass
    return out


@lru_cache(maxsize=400_000)
def undo(run: str, name: str) -> str | None:
    """A run of characters outside ASCII, with the reading in the wrong encoding undone; None where that is impossible."""
    read, written, times = TRANSFORMATIONS[name]
    table = _table(read)
    for _ in range(times):
        try:
            run = bytes(table[c] for c in run).decode(written)
        except (KeyError, UnicodeDecodeError):
            return None
    return None if _LOST.search(run) else run


def runs_at(text: str) -> list[tuple[int, str]]:
    """Runs outside ASCII with their places in the stripped text."""
    out, gone = [], 0
    for m in _RUN.finditer(text):
        out.append((m.start() - gone, m.group()))
        gone += len(m.group())
    return out


def infer(a: str, b: str) -> list[str]:
    """Transformations that turn every differing run of one twin into the other's, in either direction."""
    x, y = runs_at(a), runs_at(b)
    if [p for p, _ in x] != [p for p, _ in y]:
        return []
    differ = [(g, c) for (_, g), (_, c) in zip(x, y) if g != c]
    return [n for n in TRANSFORMATIONS if all(undo(g, n) == c for g, c in differ) or all(undo(c, n) == g for g, c in differ)] if differ else []


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _undo_all(used: frozenset[str]):
    """(h, name, own, told) from (record, twin): the digest of the record without a name, the digest of every form it has with its
    runs undone beside its own, and, matched already, those of the twins that tell run by run. used: all characters of the
    records; a form with another one is no record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=100_000)
        def ways(run: str) -> dict[str, str]:
            got = ((n, undo(run, n)) for n in TRANSFORMATIONS)
            return {n: new for n, new in got if new is not None and new != run and used.issuperset(new)}

        def forms(record: str) -> dict[str, str]:
            """By transformation the record with each run undone that can be."""
            swaps = {r: ways(r) for r in set(_RUN.findall(record))}
            return {n: _RUN.sub(lambda m: swaps[m.group()].get(n, m.group()), record) for n in {n for w in swaps.values() for n in w}}

        for b in batches:
            rows: list[tuple[int, str | None, int, bool]] = []
            for record, twin in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = _digest(record)
                rows.append((own, None, own, False))
                rows += ((_digest(form), n, own, False) for n, form in forms(record).items())
                if twin != record:
                    rows += ((_digest(twin), n, own, True) for n in infer(record, twin))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["h", "name", "own", "told"])

    return run


def vocabulary(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(record, n): words with a character outside ASCII and the number of distinct texts that hold them."""
    found = F.array_distinct(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))).alias("words")
    held = texts.where(F.length(text_col) < F.octet_length(text_col)).select(F.xxhash64(text_col).alias("h"), found).distinct().select(F.explode("words").alias("record"))
    return held.groupBy("record").agg(F.count("*").alias("n"))


def learned(texts: DataFrame, words: DataFrame, text_col: str) -> list[str]:
    """Transformations inferred from at least MIN_SUPPORT distinct pairs of twins (at most as many as there are transformations)."""
    lines = texts.select(F.explode(F.split(text_col, r"[\n.,;:!?]+")).alias("record")).where(F.col("record").rlike(r"[^\x00-\x7F]")).groupBy("record").agg(F.count("*").alias("n"))
    records = lines.unionByName(words).withColumn("skeleton", F.regexp_replace("record", r"[^\x00-\x7F]+", "")).where(F.length("skeleton") >= MIN_SKELETON)
    keyed = records.select("record", F.xxhash64("skeleton").alias("k"), F.struct("n", -F.length("record"), "record").alias("rank"))
    twins = keyed.groupBy("k").agg(F.max("rank").alias("best"), F.count("*").alias("c")).where("c > 1").select("k", F.col("best.record").alias("twin"))
    # bounded by the characters of Unicode
    used = frozenset(r["ch"] for r in words.select(F.explode(F.regexp_extract_all("record", F.lit(r"[^\x00-\x7F]"), F.lit(0))).alias("ch")).distinct().collect())
    forms = keyed.join(twins, "k").select("record", "twin").mapInArrow(_undo_all(used), "h long, name string, own long, told boolean")
    # a form is matched where some record has its digest
    there = forms.groupBy("h").agg(F.bool_or(F.col("name").isNull()).alias("held"), F.collect_set(F.when(F.col("name").isNotNull(), F.struct("name", "own", "told"))).alias("by"))
    pairs = there.select("held", "h", F.explode("by").alias("b")).where("held or b.told").select("b.name", F.least("h", "b.own").alias("one"), F.greatest("h", "b.own").alias("other")).distinct()
    return sorted(r["name"] for r in pairs.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SUPPORT).collect())


def _repairs_of(names: list[str], often: dict[str, int]):
    """often: the characters the corpus uses, with the number of times they are held."""

    def fix(word: str, name: str, n: int) -> tuple[str, bool, bool]:
        """The word with each run undone that can be, whether all characters so made are used in the corpus, and whether
        no right word looks like the garbled one: it makes several characters, holds a sign or a capital after a small letter, or the
        character it makes is held EVIDENT times as often."""
        made, was = [], []

        def one(m: re.Match) -> str:
            new = undo(m.group(), name)
            if new is None:
                return m.group()
            made.extend(new)
            was.append(m.group())
            return new

        new = _RUN.sub(one, word)
        sure = all(c in often for c in made)
        clear = sure and (len(made) > 1 or any(_SIGN.search(g) for g in was) or any(a.islower() and b.isupper() for a, b in zip(word, word[1:])) or any(often[c] >= EVIDENT * n for c in made))
        return new, sure, clear

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if "�" in word:
                    continue
                for name in names:
                    new, sure, clear = fix(word, name, n)
                    if new != word:
                        for col, x in zip(out, (word, n, new, name, TRANSFORMATIONS[name][1] == "utf-8", sure, clear)):
                            col.append(x)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["record", "n", "fixed", "name", "utf", "sure", "clear"])

    return run


def repairs(texts: DataFrame, id_col: str, text_col: str, cut=lambda df: df) -> DataFrame:
    """(record, fixed or null, name, strong) for every garbled word; fixed is null where the original can't be told.

    strong: enough by itself to tell that a text is garbled. Bytes of a one-byte encoding in a word of under STRONG
    characters are not, and count only beside a strong word garbled in the same way, unless the corpus holds the repaired
    word EVIDENT times as often. Nor are bytes of UTF-8 that a right word could hold, unless the corpus knows the repaired
    word better. Only shares of counts are compared, and counts are of distinct texts.
    """
    words = cut(vocabulary(texts, id_col, text_col))
    names = learned(texts, words, text_col)
    clean = words.where(~F.col("record").rlike(LOST))
    chars = clean.select(F.explode(F.array_distinct(F.regexp_extract_all("record", F.lit(r"[^\x00-\x7F]"), F.lit(0)))).alias("ch"), "n").groupBy("ch").agg(F.sum("n").alias("n"))
    # bounded by the characters of Unicode
    often = {r["ch"]: r["n"] for r in chars.collect()}
    least = max(3, sum(often.values()) // 100_000)
    tried = words.mapInArrow(_repairs_of(names, {c: n for c, n in often.items() if n >= least}), "record string, n long, fixed string, name string, utf boolean, sure boolean, clear boolean")
    known = tried.join(clean.select(F.col("record").alias("fixed"), F.col("n").alias("m")), "fixed", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    held = known.where((F.col("m") >= 2 * F.col("n")) | (F.col("utf") & ((F.col("m") > F.col("n")) | F.col("sure")))).withColumn(
        "rank", F.struct("m", F.col("utf"), -F.length("fixed"), "fixed", "name", "n", "clear")
    )
    mapped = held.groupBy("record").agg(F.max("rank").alias("r")).select(
        "record", F.col("r.fixed").alias("fixed"), F.col("r.name").alias("name"), F.when(F.col("r.utf"), F.col("r.clear") | (F.col("r.m") > F.col("r.n"))).otherwise((F.length("record") >= STRONG) | ((F.col("r.m") >= EVIDENT) & (F.col("r.m") >= EVIDENT * F.col("r.n")))).alias("strong")
    )
    # what was lost in decoding can only come back from a twin
    skeleton = F.regexp_replace("record", r"[^\x00-\x7F]+", "")
    lost = words.where(F.col("record").rlike(LOST)).select("record", skeleton.alias("k"), F.size(F.regexp_extract_all("record", F.lit(r"[^\x00-\x7F]+"), F.lit(0))).alias("runs"))
    best = clean.select(skeleton.alias("k"), F.size(F.regexp_extract_all("record", F.lit(r"[^\x00-\x7F]+"), F.lit(0))).alias("runs"), F.struct("n", "record").alias("rank")).where(F.length("k") >= 3)
    twins = best.groupBy("k", "runs").agg(F.max("rank").alias("r")).select("k", "runs", F.col("r.record").alias("twin"))
    restored = cut(lost.join(twins, ["k", "runs"], "left").select("record", "twin"))
    # that texts were decoded with losses is learned from twins like any other transformation, and then told of all words so marked
    if restored.where("twin is not null").limit(MIN_SUPPORT).count() < MIN_SUPPORT:
        return mapped
    return mapped.join(restored.withColumnRenamed("record", "lost"), F.col("record") == F.col("lost"), "full").select(
        F.coalesce("record", "lost").alias("record"), F.coalesce("fixed", "twin").alias("fixed"), F.coalesce("name", F.lit("lost")).alias("name"), F.coalesce("strong", F.lit(True)).alias("strong")
    )


def garbled_words(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut=lambda df: df) -> DataFrame:
    """(id, record, fixed) of every garbled word of every text.

    Null, empty and ASCII texts hold none; HTML entities are ASCII and none either. Other columns are ignored; rows of one id
    are taken together. Foreign letters used rightly stay, as the corpus knows their words better than any repair.
    """
    rep = cut(repairs(texts, id_col, text_col, cut))
    held = texts.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)))).alias("record"))
    hits = held.join(rep, "record")
    sure = hits.groupBy("id", "name").agg(F.max("strong").alias("any_strong"), F.collect_set(F.struct("record", "fixed")).alias("words")).where("any_strong")
    return sure.select(F.col("id").alias(id_col), F.explode("words").alias("w")).select(id_col, "w.record", "w.fixed")


def restored(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut=lambda df: df) -> DataFrame:
    """(id, text, fully) of each affected text, garbled words replaced where they can be told; fully: all could."""
    swaps = garbled_words(texts, id_col, text_col, cut).groupBy(id_col).agg(
        F.map_from_entries(F.collect_set(F.when(F.col("fixed").isNotNull(), F.struct("record", "fixed")))).alias("swap"), F.bool_and(F.col("fixed").isNotNull()).alias("fully")
    )
    runs = F.split(F.col(text_col), r"(?<=[ \n\t\r])|(?=[ \n\t\r])")
    new = F.array_join(F.transform(runs, lambda r: F.coalesce(F.try_element_at(F.col("swap"), r), r)), "")
    return texts.select(id_col, text_col).join(swaps, id_col).select(id_col, new.alias(text_col), "fully")
