"""Template residue, filler, error pages and script notices (problem 4).

Labelled exemplars of residue, and of policy sentences that merely speak of the same things, are held in an inverted
index. The passage windows of a text are its lines, their sentences and the marked places within them (`{{name}}`,
`[insert date]`). A window retrieves the exemplars that it shares a rare token with; TF-IDF containment says how much of an
exemplar it holds, coverage how much of the window the exemplars of that kind explain. Windows high in both are residue,
unless an exemplar of a policy sentence fits better. Document frequencies are counted over the whole corpus.

An exemplar is posted under its heaviest tokens only, those of which any sufficient containment must hold at least one; so
most texts are passed over after one look at their words, and nothing is lost.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.lookalikes import ODD, looks_like
from palimpsest.llm.residue_exemplars import CUES, EXEMPLARS, FILLER_SEEDS

#: Least containment where the exemplars of a kind explain a window together, and where one does so alone; least coverage by one, by a kind, of a clause.
CONTAINMENT, OWN_CONTAINMENT, COVERAGE, KIND_COVERAGE, CLAUSE_COVERAGE = 0.6, 0.7, 0.65, 0.8, 0.9
FILLER_WORDS = 20_000  # most words of filler the model learns, the most frequent first
NUMBER, FILLER, FIELD, BLANK = "0", "⟨filler⟩", "⟨field⟩", "⟨blank⟩"

_TOKEN = re.compile(r"[^\W_]+")
_DIGIT = re.compile(r"\d")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_CLAUSE = re.compile(r"\s*[,;:(–—]\s*|\s+-\s+")
_DOTS = re.compile(r"\b(?:x{3,}|\.{4,}|_{4,})\b", re.I)
#: Signs that can open a marked place, and marked places by their signs.
_OPEN = re.compile(r"[\[{<«]|%%|@@|__")
_PLACE = re.compile(
    r"(\{\{\{?)([^{}\n]*)(\}?\}\})|(\{%-?)([^%\n]*)(%\})|(<%[=-]?)([^%\n]*)(%>)|([$#@]\{)([^{}\n]*)(\})|(\{)([^{}\n]*)(\})"
    r"|(\[\[)([^\[\]\n]*)(\]\])|(\[)([^\[\]\n]*)(\])|(<)([^<>\n]*)(>)|(«)([^«»\n]*)(»)|(%%)([^%\n]+)(%%)|(@@)([^@\n]+)(@@)|(__)(?=\S)([^\n]*?)(?<=\S)(__)"
)
_NAME = re.compile(r"[-\s|]*[^\W\d][\w]*(?:[.\-|:][\w]+)*[-\s|]*")
_CAPITALS = re.compile(r"[A-Z][A-Z _-]+")
_SIGNS_ONLY = re.compile(r"[\s●•…_.]+")
#: One sign stands for all that open the same kind of place.
_SAME = {"{{{": "{{", "{%-": "{%", "<%=": "<%", "<%-": "<%", "#{": "${", "@{": "${"}


def words(window: str) -> list[str]:
    """Words of a window in lower case; each number, code or hash is 0, a run of filler signs 'xxxx'."""
    w = window if window.isascii() else looks_like(window)
    if "xx" in w or "XX" in w or "...." in w or "____" in w:
        w = _DOTS.sub(" xxxx ", w)
    toks = _TOKEN.findall(w.casefold())
    return [t if t.isalpha() or not _DIGIT.search(t) else NUMBER for t in toks] if _DIGIT.search(w) else toks


def places(line: str) -> list[list[str]]:
    """Tokens of each marked place of a line: the opening sign, what stands within, and the closing sign.

    Between square or angle brackets, each run of words other than CUES is one field. Elsewhere a name in the manner of a
    variable is a field, and so are capitals within « », %%, @@ or __. Dots and blanks are one blank.
    """
    out = []
    if _OPEN.search(line):
        for m in _PLACE.finditer(line):
            at = m.lastindex
            sign, inner = m.group(at - 2), m.group(at - 1)
            sign = _SAME.get(sign, sign)
            if not inner.strip():
                continue
            inside = words(inner)
            if _SIGNS_ONLY.fullmatch(inner):
                body = [BLANK]
            elif sign in ("[", "<"):
                body = [t for t, _ in groupby(t if t in CUES else FIELD for t in inside)]
            elif sign in ("«", "__", "%%", "@@"):
                body = [FIELD] if _CAPITALS.fullmatch(inner) or sign != "«" and len(inside) <= 4 else inside
            else:
                body = [FIELD] if _NAME.fullmatch(inner) and (sign != "{" or len(inner.strip()) > 2) else inside
            out.append(["open " + sign, *body, "close " + sign])
    return out


def exemplar_bags() -> list[tuple[str, Counter]]:
    """(kind, tokens) of every exemplar. An exemplar that is one marked place alone has the tokens of a place."""
    out = []
    for kind, text in EXEMPLARS:
        marked = places(text) if kind == "place" else []
        out.append((kind, Counter(marked[0] if marked else [FILLER if t in FILLER_SEEDS else t for t in words(text)])))
    return out


def word_codes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of many strings at once: (string, code) of each, and the word of each code, as `words` has them.

    Strings with characters outside plain Latin text are left to `words`.
    """
    odd = pc.fill_null(pc.match_substring_regex(strings, ODD), False)
    split = pc.split_pattern_regex(pc.utf8_lower(pc.if_else(odd, "", strings)), r"[^\pL\pN]+")
    coded = split.flatten().dictionary_encode()
    at, code = pc.list_parent_indices(split).to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False)
    names: dict[str, int] = {}
    same = np.array([names.setdefault((words(w) or [""])[0], len(names)) for w in coded.dictionary.to_pylist()], dtype=np.int64)
    at, code = [at], [same[code] if len(same) else code]
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        found = words(strings[int(i)].as_py())
        at.append(np.full(len(found), i))
        code.append(np.array([names.setdefault(w, len(names)) for w in found], dtype=np.int64))
    return np.concatenate(at), np.concatenate(code), list(names)


def corpus_counts(texts: DataFrame, text_col: str, flush: int = 200_000) -> DataFrame:
    """(token, n, n_filler): texts that hold a token, and texts that hold it in a line beside two words of known filler.

    The row of the empty token counts all texts. Counts are added up within a task before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, beside = Counter(), Counter()

        def out() -> pa.RecordBatch:
            keys = list(held)
            b = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([held[k] for k in keys], pa.int64()), pa.array([beside[k] for k in keys], pa.int64())], names=["token", "n", "n_filler"])
            held.clear(), beside.clear()
            return b

        for b in batches:
            col = b.column(0)
            at, code, names = word_codes(col)
            pair = np.unique(at.astype(np.int64) * max(len(names), 1) + code) if len(at) else np.zeros(0, np.int64)
            row, code = np.divmod(pair, max(len(names), 1))
            for k, n in enumerate(np.bincount(code, minlength=len(names)).tolist()):
                if names[k]:
                    held[names[k]] += n
            held[""] += len(col)
            for i in np.flatnonzero(pc.match_substring_regex(col, _OPEN.pattern).to_numpy(zero_copy_only=False)):
                held.update({t for p in places(col[int(i)].as_py()) for t in p if " " in t or t[0] == "⟨"})
            seeds = np.array([n in FILLER_SEEDS for n in names], dtype=bool)
            known = np.bincount(row[seeds[code]], minlength=len(col))
            held[FILLER] += int((known > 0).sum())
            for i in np.flatnonzero(known > 1):
                lines = [set(words(line)) for line in col[int(i)].as_py().split("\n")]
                beside.update(set().union(*(x for x in lines if len(x & FILLER_SEEDS) > 1)))
            if len(held) > flush:
                yield out()
        yield out()

    rows = texts.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, "token string, n long, n_filler long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_filler").alias("n_filler"))


class Model:
    """Weights of tokens and the words of filler, as counted over a corpus."""

    def __init__(self, n_texts: int, counts: dict[str, int], filler: frozenset[str]):
        vocabulary = {t for _, bag in exemplar_bags() for t in bag}
        self.filler = filler | FILLER_SEEDS
        self.idf = {t: math.log((n_texts + 1) / (counts.get(t, 0) + 1)) + 1 for t in vocabulary}
        self.other = sorted(self.idf.values())[len(self.idf) // 2]  # weight of a token that no exemplar holds


def fit(texts: DataFrame, text_col: str) -> Model:
    """Counts the exemplars' tokens over all texts, and learns the words that stand beside known filler and hardly elsewhere.

    The driver gets as many rows as exemplars have tokens, and at most FILLER_WORDS words of filler.
    """
    vocabulary = sorted({t for _, bag in exemplar_bags() for t in bag} | {""})
    counted = corpus_counts(texts, text_col)
    known = F.col("token").isin(vocabulary)
    learned = ~known & (F.col("n_filler") >= 2) & (F.col("n_filler") >= 0.8 * F.col("n")) & ~F.col("token").isin(*sorted(FILLER_SEEDS), NUMBER)
    kept = counted.where(known | learned).select("token", "n", known.alias("known")).orderBy(F.desc("known"), F.desc("n"), "token").limit(len(vocabulary) + FILLER_WORDS)
    counts, filler = {}, set()
    for r in kept.collect():
        if r.known:
            counts[r.token] = r.n
        else:
            filler.add(r.token)
    return Model(counts.pop("", 0), counts, frozenset(filler))


class Matcher:
    """Scores windows against the exemplars."""

    def __init__(self, model: Model):
        self.idf, self.other, self.filler = model.idf, model.other, model.filler
        bags = exemplar_bags()
        self.kind = [k for k, _ in bags]
        self.bags = [bag for _, bag in bags]
        self.weight = [sum(self.idf[t] * n for t, n in bag.items()) for bag in self.bags]
        self.of_kind: dict[str, set[str]] = defaultdict(set)
        self.heads: dict[str, list[int]] = defaultdict(list)
        for k, (kind, bag) in enumerate(bags):
            self.of_kind[kind] |= bag.keys()
            spare = (1 - CONTAINMENT) * self.weight[k]
            for t in sorted(bag, key=lambda t: (-self.idf[t] * bag[t], t)):  # without all of these too little would be left
                self.heads[t].append(k)
                spare -= self.idf[t] * bag[t]
                if spare < 0:
                    break
        # postings of every token as flat arrays: exemplars, and what the token is worth in each
        self.number = {t: i for i, t in enumerate(sorted({t for bag in self.bags for t in bag}))}
        listed: list[list[tuple[int, float]]] = [[] for _ in self.number]
        for k, bag in enumerate(self.bags):
            for t, n in bag.items():
                listed[self.number[t]].append((k, self.idf[t] * n))
        self.many = np.array([len(x) for x in listed])
        self.first = np.cumsum(self.many) - self.many
        self.of, self.share = np.array([k for x in listed for k, _ in x]), np.array([w for x in listed for _, w in x])
        self.least = np.array([np.inf if kind == "policy" else CONTAINMENT * w - 1e-9 for kind, w in zip(self.kind, self.weight)])
        self.looked_for = frozenset(t for t, ks in self.heads.items() if any(self.kind[k] != "policy" for k in ks)) - {FILLER} | self.filler

    def window(self, toks: list[str], clause: bool = False) -> tuple[int, float, float] | None:
        """(exemplar, containment, coverage) of the best exemplar of a window of residue, or None. The exemplars explain more of a clause."""
        bag = Counter([FILLER if t in self.filler else t for t in toks])
        near = {k for t in bag for k in self.heads.get(t, ())}
        if all(self.kind[k] == "policy" for k in near):
            return None
        idf, other = self.idf, self.other
        total = sum(idf.get(t, other if len(t) > 1 else 1.0) * n for t, n in bag.items())
        own_least, kind_least = (CLAUSE_COVERAGE,) * 2 if clause else (COVERAGE, KIND_COVERAGE)
        best, against = None, 0.0
        explained: dict[str, float] = {}
        for k in near:
            own, kind = self.bags[k], self.kind[k]
            held = sum(idf[t] * min(n, bag[t]) for t, n in own.items() if t in bag) / self.weight[k]
            if held < CONTAINMENT or kind == "place" and held < 0.999:
                continue
            share = sum(idf[t] * bag[t] for t in own if t in bag) / total
            if kind not in explained:
                vocab = self.of_kind[kind]
                explained[kind] = sum(idf[t] * n for t, n in bag.items() if t in vocab) / total
            if kind == "policy":
                against = max(against, min(held, share))
            elif share >= own_least and held >= OWN_CONTAINMENT or explained[kind] >= kind_least:
                found = (max(share, explained[kind]), held, -k)
                best = max(best, found) if best else found
        return (-best[2], best[1], best[0]) if best and best[0] >= against else None

    def line(self, line: str) -> tuple[int, float, float] | None:
        """The first window of a line that is residue: the line, a marked place, a sentence, the clause a sentence begins with."""
        toks, marked_places = words(line), places(line)
        seen = not self.looked_for.isdisjoint(toks)
        if seen and (hit := self.window(toks)) is not None:
            return hit
        for p in marked_places:
            if (hit := self.window(p)) is not None:
                return hit
        if not seen:
            return None
        parts = _SENTENCE.split(line)
        for p in parts:
            toks = words(p)
            if self.looked_for.isdisjoint(toks):
                continue
            if len(parts) > 1 and (hit := self.window(toks)) is not None:
                return hit
            first = _CLAUSE.split(p.strip(), maxsplit=1)
            if len(first) > 1 and (hit := self.window(words(first[0]), clause=True)) is not None:
                return hit
        return None

    def likely(self, lines: pa.Array, block: int = 2000) -> np.ndarray:
        """Lines that can hold residue: those that hold enough of an exemplar, whatever their windows, and those with signs of a place."""
        at, code, names = word_codes(lines)
        number = np.array([self.number.get(FILLER if n in self.filler else n, -1) for n in names], dtype=np.int64)
        known = number[code] if len(names) else code
        at, known = at[known >= 0].astype(np.int64), known[known >= 0]
        at, known = np.divmod(np.unique(at * len(self.number) + known), len(self.number))
        out = pc.match_substring_regex(lines, _OPEN.pattern).to_numpy(zero_copy_only=False).copy()
        for start in range(0, len(lines), block):
            a, b = np.searchsorted(at, [start, start + block])
            size = self.many[known[a:b]]
            first = np.repeat(self.first[known[a:b]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if b > a else np.zeros(0, np.int64)
            k = len(self.least)
            held = np.bincount(np.repeat(at[a:b] - start, size) * k + self.of[first], weights=self.share[first], minlength=block * k).reshape(block, k)
            hits = (held >= self.least).any(axis=1)[: len(lines) - start]
            out[start : start + len(hits)] |= hits
        return out

    def batch(self, texts: pa.Array) -> Iterator[tuple[int, int, tuple[int, float, float]]]:
        """(text, line_no, hit) of every line of residue."""
        split = pc.split_pattern(texts, "\n")
        coded = split.flatten().dictionary_encode()
        hits = {}
        for i in np.flatnonzero(self.likely(coded.dictionary)):
            if hit := self.line(coded.dictionary[int(i)].as_py()):
                hits[int(i)] = hit
        if hits:
            code, text = coded.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
            for j in np.flatnonzero(np.isin(code, list(hits))):
                yield int(text[j]), int(j - np.searchsorted(text, text[j])), hits[int(code[j])]


def residue_windows(texts: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """(id, line_no, exemplar, containment, coverage) of every line that is residue or holds a window that is.

    Null and empty texts hold none; other columns are ignored; repeated rows are repeated. Sentences and marked places are
    windows of their own in lines of any length.
    """
    model = fit(texts, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(model)
        for b in batches:
            ids, nos, ex, con, cov = [], [], [], [], []
            for i, no, (k, c, v) in match.batch(b.column(1)):
                ids.append(b.column(0)[i].as_py()), nos.append(no), ex.append(EXEMPLARS[k][1]), con.append(c), cov.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(ex, pa.string()), pa.array(con, pa.float64()), pa.array(cov, pa.float64())], names=[id_col, "line_no", "exemplar", "containment", "coverage"])

    schema = f"{id_col} long, line_no int, exemplar string, containment double, coverage double"
    return texts.select(F.col(id_col).cast("long").alias(id_col), text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, schema)


def marked(texts: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """Every (id, text) with is_residue, by which residue can be excluded; null texts are no residue."""
    bad = residue_windows(texts, id_col, text_col).select(id_col).distinct().withColumn("is_residue", F.lit(True))
    return texts.select(id_col, text_col).join(bad, id_col, "left").withColumn("is_residue", F.coalesce("is_residue", F.lit(False)))
