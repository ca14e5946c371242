"""Encoding with a public byte-level BPE (problem 8) without regular expressions.

Texts of a batch are laid end to end as code points. Every code point gets a class from arrays indexed by code point, with
what must be seen ahead folded into the class. Each class is a function from state to state of a small automaton; such
functions compose associatively, so the state before every code point comes from a blocked scan, and a token starts where
state and class say so. The slices between starts are merged pair by pair, once per distinct slice (cached).
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# States: what the code point before belongs to.
FRESH, LETTERS, NUMBERS, OTHERS, SPACES, PREFIX, TWO_LEFT, ONE_LEFT = range(8)
# Classes of code points. GAP lies between texts.
L, N, O, APOS1, APOS2, PRE, LONE, WS, GAP = range(9)
BLOCK = 128


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and start[class, state]."""
    nxt, start = np.zeros((9, 8), np.uint8), np.zeros((9, 8), bool)
    for s in range(8):
        for c in range(8):
            if s == TWO_LEFT:
                nxt[c, s] = ONE_LEFT
            elif s == ONE_LEFT:
                nxt[c, s] = FRESH
            elif c in (APOS1, APOS2) and s not in (OTHERS, PREFIX):
                start[c, s], nxt[c, s] = True, ONE_LEFT if c == APOS1 else TWO_LEFT
            elif c in (L, N, O, APOS1, APOS2):
                run = {L: LETTERS, N: NUMBERS}.get(c, OTHERS)
                start[c, s], nxt[c, s] = s not in (run, PREFIX), run
            elif c == WS:
                start[c, s], nxt[c, s] = s != SPACES, SPACES
            else:
                start[c, s], nxt[c, s] = True, PREFIX if c == PRE else FRESH
        nxt[GAP, s], start[GAP, s] = FRESH, True
    return nxt, start


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(sys.maxunicode + 1, O, np.uint8)
    for cp in range(sys.maxunicode + 1):
        cat = unicodedata.category(chr(cp))[0]
        if cat in "LN":
            kind[cp] = L if cat == "L" else N
    # Code points of Unicode's White_Space.
    kind[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WS
    return kind, *_automaton()


def starts(cps: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Positions at which a token starts, in code points laid end to end with a gap after each text."""
    kind, nxt, start = _tables()
    n = len(cps)
    cls = kind[cps]
    cls[gaps] = GAP
    after = np.append(cls[1:], GAP).astype(np.uint8)
    end_or_space = (after == WS) | (after == GAP)
    space = cls == WS
    cls[space & ~end_or_space & (cps == 0x20)] = PRE
    cls[space & ~end_or_space & (cps != 0x20)] = LONE
    quote = np.flatnonzero(cps == 0x27)
    if len(quote):
        pad = np.append(cps, [0, 0])
        a, b = pad[quote + 1], pad[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        cls[quote[one]] = APOS1
        cls[quote[two]] = APOS2
    # blocked scan: compose each block's functions column by column, then the blocks, then walk in again
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, GAP, np.uint8)
    grid[:n] = cls
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    func = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8)).copy()
    for col in grid:
        func = nxt[col[:, None], func]
    total, step = func, 1
    while step < rows:  # inclusive scan over blocks by doubling
        merged = total.copy()
        merged[step:] = np.take_along_axis(total[step:], total[:-step].astype(np.intp), axis=1)
        total, step = merged, step * 2
    state = np.zeros(rows, np.uint8)
    state[1:] = total[:-1, FRESH]
    out = np.empty((BLOCK, rows), bool)
    for k, col in enumerate(grid):
        out[k] = start[col, state]
        state = nxt[col, state]
    return np.flatnonzero(out.T.reshape(-1)[:n])


class Encoder:
    """Encodes batches of texts with the ranks of a vocabulary file; keeps the ids of up to `keep` distinct slices."""

    def __init__(self, path: str, keep: int = 400_000):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.keep = keep
        self.known: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: its bytes, merged pair by pair, always the pair of least rank, leftmost first."""
        rank = self.rank
        if piece in rank:
            return [rank[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) > 400:
            return self._merge_long(parts)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [rank[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same for a long slice, with a heap of pairs and linked neighbours."""
        import heapq

        rank, n = self.rank, len(parts)
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := rank.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i] if alive[i] else -1
            if j < 0 or parts[i] + parts[j] != pair:
                continue
            parts[i], alive[j], right[i] = pair, False, right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (r := rank.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[b]))
        return [rank[parts[i]] for i in range(n) if alive[i]]

    def ids_of(self, piece: str) -> list[int]:
        got = self.known.get(piece)
        if got is None:
            got = self.merge(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= 64:
                if len(self.known) >= self.keep:
                    self.known.clear()
                self.known[piece] = got
        return got

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, the offset of each id's slice in its text (code points), and the count of ids per text.

        A null and an empty text have no ids. What looks like a special token is ordinary text.
        """
        joined = "\n".join("" if t is None else t for t in texts) + "\n"
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((0 if t is None else len(t) for t in texts), np.int64, len(texts))
        gaps = np.cumsum(lengths + 1) - 1
        at = starts(cps, gaps)
        ends = np.append(at[1:], len(cps))
        is_gap = np.zeros(len(cps), bool)
        is_gap[gaps] = True
        real = ~is_gap[at]
        at, ends = at[real], ends[real]
        ids_of, known = self.ids_of, self.known
        pieces = [joined[a:b] for a, b in zip(at.tolist(), ends.tolist())]
        ids = [known.get(p) or ids_of(p) for p in pieces]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for p in ids for x in p), np.int32, int(count.sum()))
        doc = np.searchsorted(gaps, at)
        begin = gaps - lengths
        return flat, np.repeat((at - begin[doc]).astype(np.int32), count), np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        if not hasattr(self, "bytes_of"):
            self.bytes_of = {v: k for k, v in self.rank.items()}
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _slabs(batch: pa.RecordBatch, most_chars: int = 2_000_000) -> Iterator[tuple[list, list]]:
    """Rows of a batch in runs of bounded size, so that long texts don't swell the arrays."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        ids.append(i), texts.append(t)
        size += len(t or "")
        if size >= most_chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, offsets: bool = False) -> DataFrame:
    """(id, ids[, offsets]) of every row; null and empty texts give empty lists. Rows are neither merged nor dropped."""
    where = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(where)
        for b in batches:
            for ids, rows in _slabs(b):
                flat, offs, count = enc.encode(rows)
                cut = pa.array(np.append(0, np.cumsum(count)), pa.int32())
                cols = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(cut, pa.array(flat))]
                yield pa.RecordBatch.from_arrays(cols + [pa.ListArray.from_arrays(cut, pa.array(offs))] * offsets, names=[id_col, "ids", "offsets"][: 2 + offsets])

    return texts.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, f"{id_col} long, ids array<int>" + ", offsets array<int>" * offsets)


def decode(encoded: DataFrame, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """(id, text) of rows of (id, ids); an empty list gives an empty text, a null one null."""
    where = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(where)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else enc.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=[id_col, "text"])

    return encoded.select(F.col(id_col).cast("long").alias(id_col), "ids").mapInArrow(run, f"{id_col} long, text string")


def counts(texts: DataFrame, id_col: str, text_col: str, path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_tokens, kept string columns) of every row."""
    where = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(where)
        for b in batches:
            at = 0
            for ids, rows in _slabs(b):
                extra = [b.column(2 + k).slice(at, len(ids)) for k in range(len(keep))]
                at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(enc.encode(rows)[2]), *extra], names=[id_col, "n_tokens", *keep])

    cols = [F.col(c).cast("string").alias(c) for c in keep]
    return texts.select(F.col(id_col).cast("long").alias(id_col), text_col, *cols).mapInArrow(run, f"{id_col} long, n_tokens long" + "".join(f", {c} string" for c in keep))
