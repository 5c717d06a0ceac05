"""Byte-level BPE: boundaries by transition-function scans, cached pair merging."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import slices, text_bytes

# What follows an apostrophe in the pattern's contractions: fixed values.
SHORT = "stmd"
LONG = ("re", "ve", "ll")

# The code points of the property White_Space: fixed values.
WHITE = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680]
    + [0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A]
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

LETTER, NUMBER, OTHER, SPACE = range(4)

# Input symbols of the automaton. The whitespace before a non-space is its own
# symbol, so is an apostrophe that a contraction of one or two letters follows.
IN_LETTER, IN_NUMBER, IN_OTHER, IN_SPACE, IN_LAST_BLANK, IN_LAST_SPACE, IN_SHORT, IN_LONG, IN_START = range(9)

# States: what the token in progress is made of.
NEW, SPACES, BLANK, LETTERS, NUMBERS, OTHERS, ONE_MORE, TWO_MORE = range(8)


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1
    )
    table[WHITE] = SPACE
    return table


def _step(symbol: int, state: int) -> tuple[int, bool]:
    """The state after a character and whether a token starts at it."""
    if symbol == IN_LETTER:
        if state in (ONE_MORE, TWO_MORE):
            return (NEW if state == ONE_MORE else ONE_MORE), False
        return LETTERS, state not in (BLANK, LETTERS)
    if symbol == IN_NUMBER:
        return NUMBERS, state not in (BLANK, NUMBERS)
    if symbol == IN_OTHER or (symbol in (IN_SHORT, IN_LONG) and state in (BLANK, OTHERS)):
        return OTHERS, state not in (BLANK, OTHERS)
    if symbol == IN_SPACE:
        return SPACES, state != SPACES
    return {IN_LAST_BLANK: BLANK, IN_LAST_SPACE: NEW, IN_SHORT: ONE_MORE, IN_LONG: TWO_MORE, IN_START: NEW}[symbol], True


@functools.cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the transition functions, a small closed set.

    Returns the function of each symbol, the product table (first, then second),
    the state that each function leads to from NEW, and the starts by symbol and
    state. With the product table a scan composes functions by one lookup.
    """
    symbols, states = range(IN_START + 1), range(TWO_MORE + 1)
    functions = [tuple(_step(x, s)[0] for s in states) for x in symbols]
    identity = tuple(states)
    known = list(dict.fromkeys([identity, *functions]))
    for f in known:  # grows while it is walked
        for g in functions:
            h = tuple(g[s] for s in f)
            if h not in known:
                known.append(h)
    number = {f: i for i, f in enumerate(known)}
    product = np.array([[number[tuple(g[s] for s in f)] for g in known] for f in known], np.uint8)
    starts = np.array([[_step(x, s)[1] for s in states] for x in symbols])
    return np.array([number[f] for f in functions], np.uint8), product, np.array([f[NEW] for f in known], np.uint8), starts


def scan(functions: np.ndarray, block: int = 64) -> np.ndarray:
    """The composition of all functions up to and including each place.

    Blocks are composed side by side, then the blocks' totals are scanned in
    the same way and carried into the blocks: composition is associative.
    """
    product = monoid()[1].ravel()
    k = np.int32(len(monoid()[1]))
    n = len(functions)
    width = -(-n // block)
    grid = np.zeros(block * width, np.uint8)  # function 0 is the identity
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(width, block).T)
    for t in range(1, block):
        grid[t] = product[grid[t - 1] * k + grid[t]]
    if width > 1:
        totals = scan(grid[-1], block) if width > block else _in_turn(grid[-1])
        grid[:, 1:] = product[totals[None, :-1] * k + grid[:, 1:]]
    return np.ascontiguousarray(grid.T).ravel()[:n]


def _in_turn(functions: np.ndarray) -> np.ndarray:
    product, out, f = monoid()[1], np.empty_like(functions), 0
    for i, g in enumerate(functions):
        out[i] = f = product[f, g]
    return out


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and a mask of the places where a token starts."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    n = len(points)
    if not n:
        return points, np.zeros(0, bool)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[(ends - lengths)[lengths > 0]] = True
    last[ends[lengths > 0] - 1] = True

    symbol = classes()[points]
    space = symbol == SPACE
    before_solid = np.zeros(n, bool)
    before_solid[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    symbol[before_solid] = np.where(points[before_solid] == 0x20, IN_LAST_BLANK, IN_LAST_SPACE)
    quotes = np.flatnonzero((points == 0x27) & ~last)
    if len(quotes):
        one = points[quotes + 1]
        has_two = ~last[quotes + 1]
        two = np.where(has_two, points[np.minimum(quotes + 2, n - 1)], 0)
        long = np.zeros(len(quotes), bool)
        for a, b in LONG:
            long |= (one == ord(a)) & (two == ord(b))
        symbol[quotes[np.isin(one, [ord(x) for x in SHORT])]] = IN_SHORT
        symbol[quotes[long]] = IN_LONG

    of_symbol, product, from_new, starts = monoid()
    functions = of_symbol[symbol]
    functions[first] = product[of_symbol[IN_START], functions[first]]
    after = from_new[scan(functions)]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[first] = NEW
    return points, starts[symbol, before]


def pieces(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The UTF-8 slices between boundaries, and how many each text has."""
    points, start = boundaries(texts)
    width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
    ends = np.cumsum(width, dtype=np.int64)
    at = np.flatnonzero(start)
    offsets = (ends[at] - width[at]).tolist()
    data = "".join(texts).encode()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    per_text = np.diff(np.concatenate([[0], np.searchsorted(at, np.cumsum(lengths))]))
    return [data[a:b] for a, b in zip(offsets, [*offsets[1:], *[len(data)] * bool(offsets)], strict=True)], per_text


class Merger(dict):
    """Ids of pieces by pair merging, cached as decimal text, comma-joined.

    The cache holds two generations of ``limit`` pieces each, so its memory is
    bounded while frequent pieces stay.
    """

    def __init__(self, ranks: dict[bytes, int], limit: int):
        super().__init__()
        self.ranks, self.limit, self.older = ranks, limit, {}
        self.token = {b"%d" % rank: piece for piece, rank in ranks.items()}
        self.text = {rank: b"%d" % rank for rank in ranks.values()}
        self.none = 1 + max(self.text)
        self.single = [ranks[bytes([b])] for b in range(256)]
        # Which two ids make which third: all ways to cut a token into two tokens.
        self.pairs = {
            (ranks[t[:i]], ranks[t[i:]]): r
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        }

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = b",".join([self.text[i] for i in self.merged(piece)])
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def merged(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 100:
            return self._merged_long(piece)
        none = self.none
        made = self.pairs.get
        ids = [self.single[b] for b in piece]
        pair = [made(ab, none) for ab in zip(ids, ids[1:], strict=False)]
        while pair and (least := min(pair)) < none:
            i = pair.index(least)
            ids[i] = least
            del ids[i + 1], pair[i]
            if i < len(pair):
                pair[i] = made((least, ids[i + 1]), none)
            if i:
                pair[i - 1] = made((ids[i - 1], least), none)
        return ids

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same by a heap of pairs, for long pieces."""
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1" * n)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            alive[after[i]] = 0
            after[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def decoded(self, ids: bytes) -> bytes:
        """The bytes that comma-joined ids stand for."""
        return b"".join(map(self.token.__getitem__, ids.split(b","))) if ids else b""


@functools.cache
def merger(path: str, limit: int) -> Merger:
    """The merger of a rank file, one in each worker process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Merger(ranks, limit)


def encode(texts: list[str], merge: Merger) -> Iterator[bytes]:
    """Each text's ids, comma-joined."""
    found, per_text = pieces(texts)
    ids = list(map(merge.__getitem__, found))
    at = 0
    for n in per_text.tolist():
        yield b",".join(ids[at : at + n])
        at += n


# What can be returned of each text.
OUTPUTS = {
    "ids": pa.list_(pa.int32()),
    "token_starts": pa.list_(pa.int32()),
    "decoded": pa.binary(),
    "n_tokens": pa.int64(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
SQL_TYPE = {pa.list_(pa.int32()): "array<int>", pa.binary(): "binary", pa.int64(): "long", pa.string(): "string"}


def _output(name: str, text: bytes, merge: Merger) -> object:
    if name == "ids":
        return np.array(text.split(b","), "S").astype(np.int32) if text else np.zeros(0, np.int32)
    if name == "token_starts":
        tokens = text.split(b",") if text else []
        lengths = np.fromiter((len(merge.token[t]) for t in tokens), np.int64, len(tokens))
        return (np.cumsum(lengths) - lengths).astype(np.int32)
    if name == "n_tokens":
        return text.count(b",") + 1 if text else 0
    if name == "ids_sha256":
        return hashlib.sha256(text).hexdigest()
    decoded = merge.decoded(text)
    return decoded if name == "decoded" else hashlib.sha256(decoded).hexdigest()


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    outputs: tuple[str, ...] = ("ids", "token_starts", "decoded"),
    cached: int = 300_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every whole text by a rank file, and decode the ids again.

    Tokens never cross the boundaries of the split pattern. Returns ``doc_id``
    and the ``outputs``: ``ids``, ``token_starts`` (each token's first byte in
    the UTF-8 text), ``decoded`` bytes, ``n_tokens``, and the SHA-256 digests of
    the comma-joined decimal ids and of the decoded bytes. A null text counts as
    empty and has no ids. Rows are encoded one by one, so repeated rows are
    repeated; other columns are not looked at. ``rank_file`` must be readable on
    every worker. Each worker caches the ids of ``2 * cached`` pieces at most.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = merger(rank_file, cached)
        for batch in slices(batches, "text", 2 << 20):
            encoded = list(encode([x.decode() for x in text_bytes(batch["text"])], merge))
            columns = [pa.array([_output(o, x, merge) for x in encoded], OUTPUTS[o]) for o in outputs]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *outputs])

    types = ", ".join(f"{o} {SQL_TYPE[OUTPUTS[o]]}" for o in outputs)
    return source.mapInArrow(run, f"doc_id long, {types}")
