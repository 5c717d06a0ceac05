"""Periodic runs of words by a suffix automaton whose suffix paths are recoloured word by word.

The states of the automaton of a text, with their suffix links, are a tree; the
path from the state of a prefix to the root holds all suffixes of that prefix.
Each appended word recolours that path with its own place, which is the access
of a link-cut tree. What the path was coloured with before tells, suffix by
suffix, where it ended last. A suffix that ended within its own length makes a
square, and the longest one of that distance makes the run that ends here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.text import WORD, slices

WORDS = re.compile(WORD)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

# Odd multipliers of the rolling combination of word hashes.
STEP = np.uint64(0x9E3779B97F4A7C15)
APART = np.uint64(0xD1B54A32D192ED03)


def automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Longest lengths and suffix links of the states, and the state of each prefix.

    A state has a smaller longest length than any state that links to it.
    """
    length, link, steps, prefixes, last = [0], [-1], [{}], [], 0
    for code in codes:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        steps.append({})
        state = last
        while state >= 0 and code not in steps[state]:
            steps[state][code] = new
            state = link[state]
        if state >= 0:
            target = steps[state][code]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(length)
                length.append(length[state] + 1)
                link.append(link[target])
                steps.append(steps[target].copy())
                while state >= 0 and steps[state].get(code) == target:
                    steps[state][code] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
        prefixes.append(new)
    return length, link, prefixes


def heavy_paths(length: list[int], link: list[int]) -> list[int]:
    """The topmost state of each state's heavy path.

    The whole tree is known before the first access, so its preferred paths are
    kept on heavy paths: an access meets a logarithmic number of them.
    """
    order = np.argsort(np.array(length), kind="stable").tolist()
    size = [1] * len(length)
    for state in reversed(order):
        if state:
            size[link[state]] += size[state]
    heavy, most = [-1] * len(length), [0] * len(length)
    for state in order:
        if state and size[state] > most[link[state]]:
            most[link[state]], heavy[link[state]] = size[state], state
    head = list(range(len(length)))
    for state in order:
        if state and heavy[link[state]] == state:
            head[state] = head[link[state]]
    return head


def periodic_runs(codes: list[int], least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``least`` words or more, by end, then period.

    A run has its smallest period at least twice and cannot be extended. Of a
    run that ends here, the suffix of its length less its period ended a period
    before for the last time; a later end would give a smaller period. So the
    longest suffix of each colour within its own length is a run with its
    smallest period, already extended to the left, and ends here if the next
    word breaks the period. Each access replaces what it recolours by a
    logarithmic number of segments, so that all take O(n log n).
    """
    n = len(codes)
    length, link, prefixes = automaton(codes)
    head = heavy_paths(length, link)
    # By topmost state: (longest length, colour) of its segments, the topmost last.
    coloured: dict[int, list[tuple[int, int]]] = {}
    runs = []
    for here, state in enumerate(prefixes):
        found: dict[int, int] = {}
        while state > 0:
            top, deep = head[state], length[state]
            segments = coloured.get(top)
            if segments is None:
                coloured[top] = [(deep, here)]
            else:
                longest = 0
                while segments and segments[-1][0] <= deep:
                    longest, colour = segments.pop()
                    if here - colour <= longest:
                        found[here - colour] = max(longest, found.get(here - colour, 0))
                if segments and longest < deep:
                    colour = segments[-1][1]
                    if here - colour <= deep:
                        found[here - colour] = max(deep, found.get(here - colour, 0))
                segments.append((deep, here))
            state = link[top]
        for period in sorted(found):
            whole = found[period] + period
            if whole >= least and (here + 1 == n or codes[here + 1] != codes[here + 1 - period]):
                runs.append((here + 1 - whole, whole, period))
    return runs


def _stretches(texts: list[list[str]], least: int) -> Iterator[tuple[int, int, int]]:
    """(text, first, end) of the stretches outside of which no run can lie.

    All words of a run lie in windows of half ``least`` words that the text has
    again: a period on or a period before. Windows are compared by hash; words
    that share a hash only make a stretch longer.
    """
    width = -(-least // 2)
    sizes = np.array([len(t) for t in texts], np.int64)
    n = int(sizes.sum())
    if n < width:
        return
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    hashes = np.fromiter((hash(w) for t in texts for w in t), np.int64, n).view(np.uint64)
    windows = owner[: n - width + 1] * APART
    for i in range(width):
        windows = (windows + hashes[i : n - width + 1 + i]) * STEP
        windows ^= windows >> np.uint64(31)
    inside = owner[: n - width + 1] == owner[width - 1 :]
    values = np.sort(windows[inside])
    again = np.unique(values[1:][values[1:] == values[:-1]])
    if not len(again):
        return
    at = np.minimum(np.searchsorted(again, windows), len(again) - 1)
    starts = np.flatnonzero((again[at] == windows) & inside)
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    np.add.at(change, starts + width, -1)
    covered = np.cumsum(change[:n]) > 0
    # A border where cover or text changes.
    border = np.flatnonzero((covered[1:] != covered[:-1]) | (owner[1:] != owner[:-1])) + 1
    firsts = np.concatenate(([0], border))
    lasts = np.concatenate((border, [n]))
    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
        if covered[a] and b - a >= least:
            text = int(owner[a])
            before = int(ends[text] - sizes[text])
            yield text, a - before, b - before


def _runs_of(texts: list[list[str]], least: int) -> list[list[tuple[int, int, int]]]:
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, a, b in _stretches(texts, least):
        numbers: dict[str, int] = {}
        codes = [numbers.setdefault(w, len(numbers)) for w in texts[text][a:b]]
        runs[text] += [(a + start, size, period) for start, size, period in periodic_runs(codes, least)]
    for found in runs:
        found.sort(key=lambda r: (r[0], r[2]))
    return runs


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run has after its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    dropped = np.cumsum(change[:-1])
    return " ".join(w for w, d in zip(words, dropped.tolist(), strict=True) if not d)


def find_periodic_runs(
    docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` is an array of (start, length, period) in words, by start, then
    period: all stretches of ``least`` words or more that hold their smallest
    period twice and that no neighbouring word extends. ``collapsed`` has the
    words that no run contains after its first period. A null or empty text has
    no words, no runs and an empty ``collapsed``. Rows are independent: equal
    rows get equal results, a null id stays null, an empty table gives no rows.
    Columns of other names are not looked at.

    Memory follows the longest stretch of words that a text repeats, at some
    500 bytes a word.
    """
    named = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [WORDS.findall(t or "") for t in batch["text"].to_pylist()]
            runs = _runs_of(texts, least)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(
                        [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs],
                        pa.list_(RUN),
                    ),
                    pa.array([_collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return named.mapInArrow(scan, f"doc_id bigint, n_words bigint, runs {runs}, collapsed string")
