"""Main body of web pages (problem 1): a linear-chain conditional random field over leaf blocks.

A page is the sequence of its DOM leaf blocks; for stored text, of its lines. Features are a block's ancestor tags (for
lines, what list and heading marks imply), its words, pairs of words, ends and signs; the chain adds transitions between
blocks of the main text and blocks around it. The model is trained on a bounded sample of labelled pages (parameter
`pages`), once per driver process, and decoded by Viterbi. Scores of lines are kept by each worker, as pages repeat them.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.labelled_pages import labelled_pages
from palimpsest.llm.lookalikes import looks_like

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_DIGIT = re.compile(r"\d")
_HEAD = re.compile(r"\d+(?:\.\d+)*\.?\s+\S")
_ITEM = re.compile(r"(?:[-*•»]|[a-z]\)|\(\d+\))\s")


def implied_tags(line: str) -> str:
    """Tags that the marks of a line of plain text stand for."""
    if _ITEM.match(line):
        return "li"
    return "h" if _HEAD.match(line) and len(line) < 80 else "p"


def features(line: str, tags: str = "") -> list[str]:
    """Features of one block: its words and pairs of words with case and digits levelled and look-alike characters mapped, and its shape."""
    text = (line if line.isascii() else unicodedata.normalize("NFC", looks_like(line))).strip()
    raw = _TOKEN.findall(text)
    if not raw:
        return ["blank"]
    toks = ["0" if not t.isalpha() and _DIGIT.search(t) else t.lower() for t in raw]
    words = [t for t in raw if t[0].isalnum()]
    n = len(words)
    size = n if n <= 3 else min(n, 24) // 3 + 3
    out = [f"tag={t}" for t in set(tags.split())] if tags else [f"mark={implied_tags(text)}"]
    out += ["w=" + t for t in set(toks)]
    out += [f"b={a} {b}" for a, b in set(zip(toks, toks[1:]))]
    end = toks[-1] if not toks[-1].isalnum() else "word"
    out += ["f=" + toks[0], "l=" + toks[-1], f"n={size}", f"e={end}", f"ne={size} {end}"]
    if len(toks) > 1:
        out += [f"f2={toks[0]} {toks[1]}", f"l2={toks[-2]} {toks[-1]}"]
    if text.count("  ") + text.count("\t") > 1:
        out.append("gaps")
    signs = Counter(t for t in toks if not t.isalnum() and t not in ".,;-")
    out += [f"s={t}{min(k, 3)}" for t, k in signs.items()]
    if words and not (text.isupper() or text.islower()):
        big = sum(w[0].isupper() for w in words)
        out.append(f"big={4 * big // n} {min(size, 5)}")
    out.append(f"nums={min(toks.count('0'), 3)} {min(size, 4)}")
    out.append(f"signs={min(sum(signs.values()), 4)} {min(size, 5)}")
    return out


class Chain:
    """Binary chain: one weight a feature (in favour of 'around the main text'), transitions, and weights of the two ends."""

    def __init__(self, weight: dict[str, float], move: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.weight, self.move, self.begin, self.end = weight, move, begin, end
        self.kept: dict[str, float] = {}

    def score(self, line: str, tags: str = "", keep: int = 150_000) -> float:
        if tags:
            return sum(self.weight.get(f, 0.0) for f in features(line, tags))
        s = self.kept.get(line)
        if s is None:
            w = self.weight
            s = sum(w.get(f, 0.0) for f in features(line))
            if len(self.kept) >= keep:
                self.kept.clear()
            self.kept[line] = s
        return s

    def decode(self, scores: list[float]) -> list[bool]:
        """The likeliest labelling (Viterbi)."""
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = float(self.begin[0]), float(self.begin[1]) + scores[0]
        back = []
        for s in scores[1:]:
            from0, from1 = b + m10 > a + m00, b + m11 >= a + m01
            back.append((from0, from1))
            a, b = (b + m10 if from0 else a + m00), (b + m11 if from1 else a + m01) + s
        at = b + self.end[1] > a + self.end[0]
        out = [bool(at)]
        for from0, from1 in reversed(back):
            at = from1 if at else from0
            out.append(bool(at))
        return out[::-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=2)
def train(pages: int = 2500, rounds: int = 60, seed: int = 11, least: int = 3, decay: float = 1e-4) -> Chain:
    """Fits the chain by maximum likelihood (Adam, L2) on all labelled pages at once."""
    data = labelled_pages(pages, seed)
    feats = [[features(x, tags) for tags, x, _ in p] for p in data]
    seen = Counter(f for p in feats for fs in p for f in fs)
    vocab = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    n, steps = len(data), max(map(len, data))
    mask = np.zeros((n, steps), bool)
    gold = np.zeros((n, steps), np.int64)
    where, which = [], []
    for i, p in enumerate(data):
        mask[i, : len(p)] = True
        for t, (_, _, around) in enumerate(p):
            gold[i, t] = around
            known = [vocab[f] for f in feats[i][t] if f in vocab]
            where += [i * steps + t] * len(known)
            which += known
    where_, which_ = np.array(where), np.array(which)
    last = mask.sum(1) - 1
    rows = np.arange(n)
    theta = np.zeros(len(vocab) + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for it in range(1, rounds + 1):
        w, move, begin, end = theta[:-8], theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:]
        emit = np.zeros((n, steps, 2))
        emit[:, :, 1] = np.bincount(where_, weights=w[which_], minlength=n * steps).reshape(n, steps)
        alpha, beta = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
        alpha[:, 0] = begin + emit[:, 0]
        for t in range(1, steps):
            alpha[:, t] = np.where(mask[:, t, None], _lse(alpha[:, t - 1, :, None] + move, 1) + emit[:, t], alpha[:, t - 1])
        logz = _lse(alpha[rows, last] + end, 1)
        beta[rows, last] = end
        pair = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            inside = mask[:, t + 1]
            nxt = emit[:, t + 1] + beta[:, t + 1]
            beta[:, t] = np.where(inside[:, None], _lse(move + nxt[:, None, :], 2), beta[:, t])
            pair += np.exp((alpha[:, t, :, None] + move + nxt[:, None, :] - logz[:, None, None])[inside]).sum(0)
        prob = np.exp(alpha + beta - logz[:, None, None])
        grad = np.zeros_like(theta)
        diff = np.where(mask, prob[:, :, 1] - gold, 0.0).reshape(-1)
        grad[:-8] = np.bincount(which_, weights=diff[where_], minlength=len(vocab))
        both = mask[:, 1:]
        seen_pair = np.zeros((2, 2))
        np.add.at(seen_pair, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        grad[-8:-4] = (pair - seen_pair).reshape(-1)
        grad[-4:-2] = prob[:, 0].sum(0) - np.bincount(gold[:, 0], minlength=2)
        grad[-2:] = prob[rows, last].sum(0) - np.bincount(gold[rows, last], minlength=2)
        grad = grad / n + decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.15 * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
    weight = {f: round(float(theta[i]), 4) for f, i in vocab.items() if abs(theta[i]) > 1e-3}
    return Chain(weight, theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:])


class _Leaves(HTMLParser):
    """Leaf blocks of a page with their ancestors: tags, and the words of classes and ids after a dot. Inline tags are no blocks, but
    links with nothing beside them other than signs are one each; scripts and styles are left out."""

    INLINE = frozenset("a abbr b bdi bdo br cite code em i kbd mark q s samp small span strong sub sup u wbr img input".split())
    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    HIDDEN = frozenset("script style noscript head template".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[str]]] = []
        self.text: list[tuple[bool, str]] = []  # (whether within a link, text); each link is one entry
        self.in_link = False
        self.blocks: list[tuple[str, str]] = []

    def end_block(self) -> None:
        above = " ".join(x for tag, names in self.stack for x in (tag, *names))
        links = [" ".join(t.split()) for link, t in self.text if link]
        if sum(map(bool, links)) > 1 and not any(c.isalnum() for link, t in self.text if not link for c in t):
            self.blocks += [(f"{above} a".strip(), t) for t in links if t]
        elif whole := " ".join("".join(t for _, t in self.text).split()):
            self.blocks.append((above, whole))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append((self.in_link, " "))
        elif tag == "a":
            self.in_link = True
            self.text.append((True, ""))
        if tag not in self.INLINE:
            self.end_block()
            if tag not in self.VOID:
                names = [f".{w.lower()}" for k, v in attrs if k in ("class", "id") and v for w in _TOKEN.findall(v.replace("_", "-")) if w.isalpha()]
                self.stack.append((tag, names))

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = False
        if tag not in self.INLINE and any(tag == t for t, _ in self.stack):
            self.end_block()
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(t in self.HIDDEN for t, _ in self.stack):
            if self.in_link and self.text and self.text[-1][0]:
                self.text[-1] = (True, self.text[-1][1] + data)
            else:
                self.text.append((self.in_link, data))


def leaf_blocks(html: str) -> list[tuple[str, str]]:
    """(ancestors from the root down, text) of each leaf block, in document order."""
    p = _Leaves()
    p.feed(html)
    p.close()
    p.end_block()
    return p.blocks


def around_lines(texts: DataFrame, id_col: str = "chunk_id", text_col: str = "text", pages: int = 2500) -> DataFrame:
    """(id, line_no) of every line that belongs to the page around the main text.

    Null texts hold none and blank lines are never reported, but stay in the chain as breaks. Each text is a chain of its own;
    repeated rows are each reported; other columns are ignored.
    """
    model = train(pages)
    sent = texts.sparkSession.sparkContext.broadcast((model.weight, model.move, model.begin, model.end))  # bounded by the labelled pages
    key = (pages, len(model.weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = _worker_chain(key, sent.value)
        known: dict[str, list[int]] = {}
        for b in batches:
            ids, nos = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                hits = known.get(text)
                if hits is None:
                    at, scores = [], []
                    for no, x in enumerate(text.split("\n")):
                        if x and not x.isspace():
                            at.append(no)
                            scores.append(chain.score(x))
                    hits = [no for no, y in zip(at, chain.decode(scores)) if y] if at else []
                    if len(known) >= 20_000:
                        known.clear()
                    known[text] = hits
                ids += [i] * len(hits)
                nos += hits
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32())], names=[id_col, "line_no"])

    return texts.select(F.col(id_col).cast("long").alias(id_col), text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, f"{id_col} long, line_no int")


_CHAINS: dict[tuple, Chain] = {}


def _worker_chain(key: tuple, parts: tuple) -> Chain:
    """The chain of a broadcast model, kept by the worker process with the scores it has computed."""
    if key not in _CHAINS:
        _CHAINS.clear()
        _CHAINS[key] = Chain(*parts)
    return _CHAINS[key]


def main_lines(texts: DataFrame, id_col: str = "chunk_id", text_col: str = "text", pages: int = 2500) -> DataFrame:
    """(id, text) of every row with the lines of the main text only, in order; null stays null."""
    gone = around_lines(texts, id_col, text_col, pages).groupBy(id_col).agg(F.collect_set("line_no").alias("gone"))
    kept = F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("gone", i))
    return texts.select(id_col, text_col).join(gone, id_col, "left").select(id_col, F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(text_col))


def main_body_of_html(pages_df: DataFrame, id_col: str, html_col: str, pages: int = 2500) -> DataFrame:
    """(id, text) of every page: the blocks of its main body by line. A null page gives null, a page without one ''."""
    model = train(pages)
    sent = pages_df.sparkSession.sparkContext.broadcast((model.weight, model.move, model.begin, model.end))
    key = (pages, len(model.weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = _worker_chain(key, sent.value)
        for b in batches:
            out = []
            for html in b.column(1).to_pylist():
                blocks = leaf_blocks(html) if html else []
                marks = chain.decode([chain.score(x, tags) for tags, x in blocks]) if blocks else []
                out.append(None if html is None else "\n".join(x for (_, x), y in zip(blocks, marks) if not y))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(out, pa.string())], names=[id_col, "text"])

    return pages_df.select(F.col(id_col).cast("long").alias(id_col), html_col).mapInArrow(run, f"{id_col} long, text string")
