"""Suffix-array deduplication by a distributed merge sort of sampled suffixes.

A string of ``length`` bytes that occurs twice has its smallest-hashed seed (a
shorter string at the same offset) in common, so only suffixes that start at
such seeds - anchors - have to be sorted, and of these only those whose seed
occurs again somewhere. Tasks sort their anchored suffixes into front-coded
runs, runs are exchanged by ranges of the order, and each range is merged by a
loser tree that compares strings only behind their known common prefix. Strings
that begin alike are then neighbours, and every string of ``length`` bytes of a
group of neighbours is compared.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import digest, slices, text_bytes
from riskweave.session import materialize

# Bytes of text that are hashed at once; positions in them fit POSITION_BITS.
AT_ONCE = 1 << 20
POSITION_BITS = 22

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


# Anchors.


def seed_length(length: int) -> int:
    return max(8, length * 36 // 100)


@dataclass
class Anchors:
    """Arrays by anchor: its text, place, seed hash, and the first and last start of its strings."""

    text: np.ndarray
    place: np.ndarray
    seed: np.ndarray
    first: np.ndarray
    last: np.ndarray


def find_anchors(texts: list[bytes], length: int) -> Iterator[Anchors]:
    """Anchors of all strings of ``length`` bytes, which never cross texts."""
    parts: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), AT_ONCE):
            part = text[at : at + AT_ONCE + length - 1]
            if parts and size + len(part) > AT_ONCE:
                yield _anchors(parts, length)
                parts, size = [], 0
            parts.append((i, at, part))
            size += len(part)
    if parts:
        yield _anchors(parts, length)


def _anchors(parts: list[tuple[int, int, bytes]], length: int) -> Anchors:
    seed = seed_length(length)
    buffer = b"".join(p[2] for p in parts)
    n = len(buffer)
    eights = np.ndarray((n - 7,), "<u8", buffer, 0, (1,))  # the eight bytes from each place on
    m = n - seed + 1
    hashes = np.zeros(m, np.uint64)
    for i, at in enumerate([*range(0, seed - 8, 8), seed - 8]):
        hashes ^= eights[at : at + m]
        hashes *= np.uint64(MULTIPLIERS[i % 3])
        hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(MULTIPLIERS[0])
    hashes ^= hashes >> np.uint64(32)

    # The leftmost smallest hash among the seeds inside each string.
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = (hashes & ~low) | np.arange(m, dtype=np.uint64)
    width, wanted = 1, length - seed + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step

    lengths = np.array([len(p[2]) for p in parts])
    starts = np.cumsum(lengths) - lengths
    inside = np.zeros(n + 1, np.int8)
    inside[starts] += 1
    inside[starts + lengths - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[: n - length + 1], dtype=np.int8))
    least = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    place = (least[begin] & low).astype(np.int64)
    part = np.searchsorted(starts, at[begin], "right") - 1
    shift = np.array([p[1] for p in parts])[part] - starts[part]
    text = np.array([p[0] for p in parts])[part]
    return Anchors(text, place + shift, hashes[place].view(np.int64), at[begin] + shift, at[end] + shift)


def _seed_rows(length: int, at_once: int = 1 << 20):
    """Rows of (seed, salt, k, n): a run's seeds, those it repeats counted twice.

    However often a run has a seed, one of its rows goes to the seed's own
    partition (salt 0); the others are known to be repeated and are dealt apart.
    """

    def emit(seeds: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        seed, key = np.concatenate(seeds), np.concatenate(keys)
        order = np.lexsort((key, seed))
        seed, key = seed[order], key[order]
        same = np.append(False, seed[1:] == seed[:-1])
        again = same & np.append(False, key[1:] == key[:-1])
        twice = same | np.append(same[1:], False)
        salt = np.where(same, 1 + np.arange(len(seed)) % 997, 0).astype(np.int32)
        n = np.where(twice, 2, 1).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x[~again]) for x in (seed, salt, key, n)], names=["seed", "salt", "k", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, keys, held = [], [], 0
        for batch in slices(batches, "text"):
            k = batch["k"].to_numpy()
            for found in find_anchors(text_bytes(batch["text"]), length):
                seeds.append(found.seed)
                keys.append(k[found.text])
                held += len(found.seed)
                if held >= at_once:
                    yield emit(seeds, keys)
                    seeds, keys, held = [], [], 0
        if held:
            yield emit(seeds, keys)

    return run


# Runs: sorted suffixes, front-coded.


@dataclass(slots=True)
class Suffix:
    """A suffix with its context: ``key`` is the text from the anchor on to the
    end of its last string, then the text from its first string to the anchor."""

    key: bytes
    right: int
    no_id: bool
    doc_id: int
    text_digest: int
    k: int
    place: int

    @property
    def rank(self) -> tuple:
        """Its place in the order of documents."""
        return self.no_id, self.doc_id, self.text_digest, self.place


FIELDS = np.dtype(
    [("lcp", "<u4"), ("rest", "<u4"), ("right", "<u4"), ("no_id", "u1"), ("doc_id", "<i8"), ("td1", "<i8"), ("k", "<i8"), ("place", "<i8")]
)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """How long two strings agree, given that they do so for ``known`` bytes."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n
    while high - low > 8:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    while a[low] == b[low]:
        low += 1
    return low


def front_code(run: list[Suffix]) -> bytes:
    """A sorted run: what each key shares with the one before it is left out."""
    fields, rests, before = np.zeros(len(run), FIELDS), [], b""
    for i, s in enumerate(run):
        lcp = common_prefix(before, s.key)
        fields[i] = (lcp, len(s.key) - lcp, s.right, s.no_id, s.doc_id, s.text_digest, s.k, s.place)
        rests.append(s.key[lcp:])
        before = s.key
    return len(run).to_bytes(8, "little") + fields.tobytes() + b"".join(rests)


def decode_run(data: bytes) -> Iterator[tuple[int, Suffix]]:
    """The suffixes of a run with the common prefix of each and the one before."""
    n = int.from_bytes(data[:8], "little")
    at, key = 8 + n * FIELDS.itemsize, b""
    for lcp, rest, right, no_id, doc_id, td1, k, place in np.frombuffer(data, FIELDS, n, 8).tolist():
        key = key[:lcp] + data[at : at + rest]
        at += rest
        yield lcp, Suffix(key, right, bool(no_id), doc_id, td1, k, place)


def merge_runs(runs: list[bytes]) -> Iterator[tuple[int, Suffix]]:
    """All suffixes in order, each with its common prefix with the one before.

    A loser tree over the runs. Every contender carries its common prefix with
    the suffix that came out last; of two, the one with the longer prefix is the
    smaller and no byte is looked at; if they are equal, bytes are compared from
    there on only, and the loser's prefix with the winner is what it keeps.
    """
    width = 1
    while width < max(1, len(runs)):
        width *= 2
    sources = [decode_run(r) for r in runs] + [iter(())] * (width - len(runs))
    # A contender: [common prefix with the last output, suffix or None, run].
    heads = [[*next(s, (0, None)), i] for i, s in enumerate(sources)]

    def play(a: list, b: list) -> tuple[list, list]:
        """Winner and loser; the loser's prefix is then the one with the winner."""
        if a[1] is None or b[1] is None:
            return (b, a) if a[1] is None else (a, b)
        if a[0] != b[0]:
            return (a, b) if a[0] > b[0] else (b, a)
        x, y = a[1], b[1]
        lcp = common_prefix(x.key, y.key, a[0])
        if lcp == len(x.key) or lcp == len(y.key):
            smaller = (len(x.key), x.right, x.rank) <= (len(y.key), y.right, y.rank)
        else:
            smaller = x.key[lcp] < y.key[lcp]
        winner, loser = (a, b) if smaller else (b, a)
        loser[0] = lcp
        return winner, loser

    losers: list = [None] * width
    level = heads
    nodes = width
    while len(level) > 1:
        nodes //= 2
        winners = []
        for i in range(nodes):
            winner, losers[nodes + i] = play(level[2 * i], level[2 * i + 1])
            winners.append(winner)
        level = winners
    winner = level[0]
    winner[0] = 0
    while winner[1] is not None:
        yield winner[0], winner[1]
        run = winner[2]
        winner = [*next(sources[run], (0, None)), run]
        node = (width + run) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


# Groups of neighbours.


def repeated_strings(group: list[Suffix], length: int) -> Iterator[tuple[Suffix, int, int]]:
    """Spans of later occurrences among suffixes with a common seed: suffix, start, end.

    Of suffixes alike in their whole context all but the first are repeated from
    end to end. If contexts differ, the first of each are compared string by
    string, one offset from the anchor after the other.
    """
    firsts: dict[tuple[bytes, int], Suffix] = {}
    for s in group:
        first = firsts.setdefault((s.key, s.right), s)
        if s.rank < first.rank:
            firsts[s.key, s.right] = s
    for s in group:
        if s.rank > firsts[s.key, s.right].rank:
            begin = s.place - (len(s.key) - s.right)
            yield s, begin, s.place + s.right
    if len(firsts) == 1:
        return
    contexts = []
    for s in sorted(firsts.values(), key=lambda s: s.rank):
        left = len(s.key) - s.right
        contexts.append((s, left, s.right - length, s.key[s.right :] + s.key[: s.right]))
    spans: list[list[list[int]]] = [[] for _ in contexts]
    for offset in range(max(c[1] for c in contexts), min(-c[2] for c in contexts) - 1, -1):
        seen = set()
        for (s, left, ahead, text), mine in zip(contexts, spans, strict=True):
            if -ahead <= offset <= left:
                at = left - offset
                string = text[at : at + length]
                if string in seen:
                    start = s.place - offset
                    if mine and mine[-1][1] >= start:
                        mine[-1][1] = start + length
                    else:
                        mine.append([start, start + length])
                else:
                    seen.add(string)
    for (s, *_), mine in zip(contexts, spans, strict=True):
        for start, end in mine:
            yield s, start, end


def all_strings(group: list[Suffix], length: int) -> Iterator[tuple[Suffix, int, bytes]]:
    """Every string of the suffixes: suffix, start, string."""
    for s in group:
        left = len(s.key) - s.right
        text = s.key[s.right :] + s.key[: s.right]
        for at in range(len(text) - length + 1):
            yield s, s.place - left + at, text[at : at + length]


# The operator.

SPANS = "part int, run binary, k long, no_id boolean, doc_id long, td1 long, start long, end long, w1 long, w2 long"
ARROW_SPANS = pa.schema(
    [("part", pa.int32()), ("run", pa.binary()), ("k", pa.int64()), ("no_id", pa.bool_()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("td1", "start", "end", "w1", "w2")]
)


def _rows(**columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in ARROW_SPANS]
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW_SPANS)


def _span_rows(spans: list[tuple[Suffix, int, int]]) -> pa.RecordBatch:
    suffixes, starts, ends = zip(*spans, strict=True)
    return _rows(
        part=[s.place % 9973 for s in suffixes],  # dealt evenly; spans only pass through
        k=[s.k for s in suffixes], no_id=[s.no_id for s in suffixes], doc_id=[s.doc_id for s in suffixes],
        td1=[s.text_digest for s in suffixes], start=starts, end=ends,
    )


def _joined(spans: list[tuple[Suffix, int, int]]) -> list[tuple[Suffix, int, int]]:
    """Spans of one document that touch, as one."""
    out: list[tuple[Suffix, int, int]] = []
    for s, start, end in sorted(spans, key=lambda x: (x[0].rank[:3], x[1])):
        if out and out[-1][0].rank[:3] == s.rank[:3] and start <= out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(out[-1][2], end))
        else:
            out.append((s, start, end))
    return out


def _make_runs(length: int, splitters: list[bytes], at_once: int):
    """Sorted runs of the suffixes whose seed is repeated, cut by the splitters."""
    seed = seed_length(length)

    def emit(run: list[Suffix]) -> Iterator[pa.RecordBatch]:
        run.sort(key=lambda s: (s.key, s.right, s.no_id, s.doc_id, s.text_digest, s.place))
        kept, spans = [], []
        for s in run:
            if kept and kept[-1].right == s.right and kept[-1].key == s.key:
                if s.rank > kept[-1].rank:
                    spans.append((s, s.place - (len(s.key) - s.right), s.place + s.right))
            else:
                kept.append(s)
        run.clear()
        parts = groupby(kept, key=lambda s: bisect.bisect_right(splitters, s.key[:seed]))
        for part, mine in parts:
            yield _rows(part=[part], run=[front_code(list(mine))])
        if spans:
            yield _span_rows(_joined(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Suffix] = []
        for batch in slices(batches, "text"):
            texts = text_bytes(batch["text"])
            # A seed that is repeated is so for every text that has it.
            wanted = np.unique(batch["seeds"].flatten().to_numpy())
            k, ids, td1 = batch["k"].to_pylist(), batch["doc_id"].to_pylist(), batch["td1"].to_pylist()
            for found in find_anchors(texts, length):
                mine = np.flatnonzero(np.isin(found.seed, wanted))
                for i, place, first, last in zip(*(x[mine].tolist() for x in (found.text, found.place, found.first, found.last)), strict=True):
                    text = texts[i]
                    end = last + length
                    held.append(Suffix(text[place:end] + text[first:place], end - place, ids[i] is None, ids[i] or 0, td1[i], k[i], place))
                if len(held) >= at_once:
                    yield from emit(held)
        if held:
            yield from emit(held)

    return run


def _merge_parts(length: int, most_in_group: int):
    seed = seed_length(length)

    def merged(runs: list[bytes]) -> Iterator[pa.RecordBatch]:
        spans: list = []
        group: list[Suffix] = []
        over = False

        def close() -> Iterator[pa.RecordBatch]:
            if over:
                yield _string_rows(list(all_strings(group, length)))
            elif len(group) > 1:
                spans.extend(repeated_strings(group, length))

        for lcp, suffix in merge_runs(runs):
            if lcp < seed:
                yield from close()
                group, over = [], False
            group.append(suffix)
            if len(group) >= most_in_group:
                # Too many for one task: their strings are compared by all tasks.
                over = True
                yield from close()
                group = []
            if len(spans) >= 100_000:
                yield _span_rows(_joined(spans))
                spans = []
        yield from close()
        if spans:
            yield _span_rows(_joined(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = None, []
        for batch in batches:
            is_run = batch["run"].is_valid()
            through = batch.filter(pc.invert(is_run))
            if through.num_rows:
                yield through
            mine = batch.filter(is_run)
            for p, data in zip(mine["part"].to_pylist(), mine["run"].to_pylist(), strict=True):
                if p != part and runs:
                    yield from merged(runs)
                    runs = []
                part = p
                runs.append(data)
        if runs:
            yield from merged(runs)

    return run


def _string_rows(strings: list[tuple[Suffix, int, bytes]]) -> pa.RecordBatch:
    suffixes, starts, texts = zip(*strings, strict=True) if strings else ((), (), ())
    hashes = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), np.int64).reshape(-1, 2)
    return _rows(
        k=[s.k for s in suffixes], no_id=[s.no_id for s in suffixes], doc_id=[s.doc_id for s in suffixes],
        td1=[s.text_digest for s in suffixes], start=starts, w1=hashes[:, 0], w2=hashes[:, 1],
    )


def repeated_spans(
    docs: DataFrame, length: int, part_bytes: int, run_suffixes: int, most_in_group: int
) -> DataFrame:
    """``k``, ``no_id``, ``doc_id``, ``td1``, ``start``, ``end``: spans that a string starting earlier covers.

    ``docs`` has ``k`` (the join key), ``doc_id``, ``td1`` and ``text``.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // part_bytes
    seeds = docs.select("k", "text").mapInArrow(_seed_rows(length), "seed long, salt int, k long, n int")
    total = F.sum("n").over(Window.partitionBy("seed", "salt"))
    repeated = seeds.withColumn("total", total).where("total > 1").groupBy("k").agg(F.collect_set("seed").alias("seeds"))
    wanted = docs.join(repeated, "k").select("k", "doc_id", "td1", "text", "seeds")
    runs = wanted.mapInArrow(_make_runs(length, _splitters(docs, length, parts), run_suffixes), SPANS)
    dealt = runs.repartition(parts, "part").sortWithinPartitions("part")
    found = materialize(dealt.mapInArrow(_merge_parts(length, most_in_group), SPANS).drop("part", "run"), "spans")

    # Strings of groups that were too large for a task, compared by hash.
    order = F.struct("no_id", "doc_id", "td1", "start")
    strings = found.where("w1 is not null")
    first = strings.groupBy("w1", "w2").agg(F.min(order).alias("first"))
    later = strings.join(first, ["w1", "w2"]).where(order > F.col("first"))
    columns = ["k", "no_id", "doc_id", "td1", "start"]
    later = later.select(*columns, (F.col("start") + length).alias("end"))
    return found.where("w1 is null").select(*columns, "end").unionByName(later)


def _splitters(docs: DataFrame, length: int, parts: int, per_part: int = 20) -> list[bytes]:
    """Seeds that cut the order into ``parts`` ranges, from a sample of texts drawn by hash.

    They only balance the work. About ``per_part`` seeds per range reach the driver.
    """
    if parts == 1:
        return []
    seed = seed_length(length)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = text_bytes(batch["text"])
            for found in find_anchors(texts, length):
                picked = np.flatnonzero(found.seed % 256 == 0)
                strings = [texts[found.text[i]][found.place[i] : found.place[i] + seed] for i in picked]
                yield pa.RecordBatch.from_arrays([pa.array(found.seed[picked]), pa.array(strings, pa.binary())], names=["h", "s"])

    n = docs.count()
    share = min(1.0, 64.0 * parts / max(1, n))
    drawn = docs.where(F.shiftrightunsigned("td1", 11) < share * float(1 << 53)).select("text")
    rows = drawn.mapInArrow(sample, "h long, s binary").orderBy("h").limit(parts * per_part).collect()
    strings = sorted({bytes(r["s"]) for r in rows})
    return [strings[i * len(strings) // parts] for i in range(1, parts)] if strings else []


OUTPUT = "doc_id long, td1 long, n_bytes long, n_removed long, starts array<long>, ends array<long>"


def dedup_substrings(
    docs: DataFrame,
    length: int = 100,
    whole: bool = True,
    part_bytes: int = 16 << 20,
    run_suffixes: int = 100_000,
    most_in_group: int = 50_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Texts are UTF-8 bytes, a null text is empty. Earlier is a smaller id (null
    last; of equal ids the text digest decides) or an earlier start in the same
    document. Occurrences may overlap, and all are judged on the input. Rows
    equal in id and text are one document and get one result. Other columns are
    not looked at.

    Per row: ``doc_id``, ``td1``, ``n_bytes``, ``n_removed``, the removed runs'
    ``starts`` and ``ends`` in bytes, and ``kept`` (the remaining bytes, which
    may cut a character) or, without ``whole``, their ``kept_sha256``.
    """
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(text, "t")[0], text.alias("text"))
    source = source.withColumn("k", F.coalesce("doc_id", "td1"))
    spans = repeated_spans(source, length, part_bytes, run_suffixes, most_in_group)
    member: Column = F.struct("no_id", "td1", "start", "end")
    gathered = spans.groupBy("k").agg(F.collect_list(member).alias("spans"))
    joined = source.join(gathered, "k", "left").select("doc_id", "td1", "text", "spans")
    last = pa.field("kept", pa.binary()) if whole else pa.field("kept_sha256", pa.string())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, td1, texts = batch["doc_id"].to_pylist(), batch["td1"].to_pylist(), text_bytes(batch["text"])
            found = [_union(s, i is None, t) for s, i, t in zip(batch["spans"].to_pylist(), ids, td1, strict=True)]
            kept = [_outside(t, s) for t, s in zip(texts, found, strict=True)]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["td1"],
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(x) for t, x in zip(texts, kept, strict=True)], pa.int64()),
                    pa.array([[a for a, _ in s] for s in found], longs),
                    pa.array([[b for _, b in s] for s in found], longs),
                    pa.array(kept if whole else [hashlib.sha256(x).hexdigest() for x in kept], last.type),
                ],
                names=["doc_id", "td1", "n_bytes", "n_removed", "starts", "ends", last.name],
            )

    return joined.mapInArrow(cut, f"{OUTPUT}, {last.name} {'binary' if whole else 'string'}")


def _union(spans: list[dict] | None, no_id: bool, td1: int) -> list[list[int]]:
    """The spans of one document as maximal runs."""
    runs: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or () if s["no_id"] == no_id and s["td1"] == td1):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return runs


def _outside(text: bytes, runs: list[list[int]]) -> bytes:
    edges = [0, *(x for r in runs for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
