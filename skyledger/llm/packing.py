"""Documents packed into sequences of a fixed number of tokens, by non-negative least squares over their lengths.

1. Each document becomes token ids with an end id, cut into whole windows and a rest; pieces are written once, each
   with its rank among the equally long pieces of its task.
2. The histogram of lengths, which has at most ``window`` bins however many documents there are, goes to the driver.
   Every combination of up to ``DEPTH`` lengths that fills a window exactly is a strategy; non-negative least squares
   finds how often each must be repeated to use up the histogram. The counts are rounded, and never use more pieces of
   a length than there are.
3. What rounding and longer combinations leave is packed greedily: the longest pieces that fit, then a part of the
   longest piece for the gap. So only a few pieces are cut. The very last tokens, less than a window, make sequences
   of powers of two, which need no padding: no sequence is padded.
4. The plan names ranks within a bin, not documents. A piece's rank is its rank in its task plus what earlier tasks
   hold of its bin; no bin is gathered or sorted, so one length may hold any share of all pieces.

Null texts are empty, and an empty document is its end id alone. Rows that repeat an id are documents of their own,
null ids included. Long texts take several sequences. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.encoders import ragged, word_units
from skyledger.session import stage

WINDOW = 2048
# Lengths in one strategy. The number of strategies grows with window ** (DEPTH - 1): 350,000 for 3 lengths in 2,048.
DEPTH = 3
END_ID = 1
# Steps of the solver at most; each touches as many strategies as have no length in common.
STEPS = 250
# Pieces placed at once: 4 MB of ids at most with whole windows.
ROWS = 500
# Rows of the table of ranks (8 MB) that may be broadcast.
SMALL_CELLS = 300_000

PIECES = "part int, doc_id long, start long, length int, nth long, doc_tokens long, ids binary"
PLACED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


# --- the plan: lengths only, on the driver ------------------------------------------


def strategies(window: int, depth: int, have: np.ndarray) -> np.ndarray:
    """Ascending lengths, padded in front with 0, that sum to the window; only lengths ``have`` marks."""
    lengths = np.flatnonzero(have)
    found = [np.zeros((0, depth), np.int32)]
    # Combinations of the smaller lengths; the largest is what is left of the window.
    open_, total = np.zeros((1, 0), np.int32), np.zeros(1, np.int64)
    for size in range(1, depth):
        low = open_[:, -1] if size > 1 else np.ones(1, np.int64)
        first = np.searchsorted(lengths, low)
        # A combination goes on with lengths of which at least one more, as long, fits.
        last = np.searchsorted(lengths, (window - total) // 2, side="right")
        n = np.maximum(last - first, 0)
        row = np.repeat(np.arange(len(n)), n)
        nxt = lengths[ragged(first, n)]
        open_ = np.column_stack([open_[row], nxt]).astype(np.int32)
        total = total[row] + nxt
        rest = window - total
        full = have[rest]
        done = np.column_stack([open_[full], rest[full]])
        found.append(np.pad(done, ((0, 0), (depth - done.shape[1], 0))).astype(np.int32))
    return np.concatenate(found)


def solve(columns: np.ndarray, counts: np.ndarray, steps: int = STEPS, least_gain: float = 1e-6) -> np.ndarray:
    """Repeats x >= 0 of each strategy that bring the lengths used near ``counts`` in least squares.

    Coordinate descent: each step moves, exactly along its own axis, every strategy that has the largest gain among
    all that share a length with it. They touch different lengths, so their moves don't disturb each other. It ends
    when no move gains ``least_gain`` of the first one.
    """
    rest = counts.astype(np.float64)
    rest[0] = 0.0
    x = np.zeros(len(columns))
    if not len(columns):
        return x
    depth = columns.shape[1]
    used = columns > 0
    square = sum(used[:, i] * sum((columns[:, i] == columns[:, j]) & used[:, i] for j in range(depth)) for i in range(depth))
    first_gain = None
    for _ in range(steps):
        slope = rest[columns].sum(axis=1)
        move = np.maximum(slope / square, -x)
        gain = slope * move - 0.5 * square * move * move
        best = gain.max()
        first_gain = first_gain or best
        if best <= least_gain * first_gain:
            break
        top = np.argpartition(gain, -min(len(gain), 20_000))[-min(len(gain), 20_000) :]
        top = top[np.argsort(gain[top], kind="stable")]
        owner = np.full(len(rest), -1)
        for i in range(depth):
            np.maximum.at(owner, columns[top, i], np.arange(len(top)))
        place = np.arange(len(top))
        alone = (gain[top] > 0) & np.all((columns[top] == 0) | (owner[columns[top]] == place[:, None]), axis=1)
        chosen = top[alone]
        x[chosen] += move[chosen]
        for i in range(depth):
            np.subtract.at(rest, columns[chosen, i], move[chosen])
        rest[0] = 0.0
    return x


@dataclass
class Plan:
    """Where the pieces of each bin go: runs of ranks, a part of each piece, its sequence and its place there."""

    window: int
    counts: np.ndarray
    runs: list[list[tuple[int, int, int, int]]] = field(init=False)
    places: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def __post_init__(self):
        self.counts = self.counts.astype(np.int64)
        # Of each length: (bin, first rank, number of pieces, first token of the part).
        self.runs = [[(n, 0, int(c), 0)] if c else [] for n, c in enumerate(self.counts)]

    def _take(self, length: int, n: int) -> list[tuple[int, int, int, int]]:
        taken, runs = [], self.runs[length]
        self.counts[length] -= n
        while n:
            bin_, first, count, begin = runs.pop()
            use = min(n, count)
            taken.append((bin_, first, use, begin))
            if use < count:
                runs.append((bin_, first + use, count - use, begin))
            n -= use
        return taken

    def repeat(self, parts: list[tuple[int, int]], times: int) -> None:
        """``times`` sequences of the same parts (length of a piece, tokens used of it); what is not used stays."""
        offset = 0
        for length, use in parts:
            at = self.sequences
            for bin_, first, count, begin in self._take(length, times):
                self.places.append((bin_, first, count, begin, use, at, offset))
                at += count
                if use < length:
                    self.counts[length - use] += count
                    self.runs[length - use].append((bin_, first, count, begin + use))
            offset += use
        self.sequences += times

    def fill(self, size: int) -> None:
        """Sequences of ``size`` tokens: the longest pieces that fit, then a part of the longest; as often as they last."""
        parts, free, gap = [], self.counts.copy(), size
        while gap:
            fits = np.flatnonzero(free[1 : gap + 1])
            if len(fits):
                length = int(fits[-1]) + 1
                n = min(gap // length, int(free[length]))
                parts += [(length, length)] * n
            else:
                length, n = int(np.flatnonzero(free)[-1]), 1
                parts.append((length, gap))
            free[length] -= n
            gap -= min(length, gap) * n
        used = self.counts - free
        some = used > 0
        self.repeat(parts, int((self.counts[some] // used[some]).min()))

    @property
    def tokens(self) -> int:
        return int((self.counts * np.arange(len(self.counts))).sum())


def plan(counts: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> Plan:
    """``counts[n]`` pieces of n tokens, n up to the window, placed without padding."""
    made = Plan(window, counts)
    if made.counts[window]:
        made.repeat([(window, window)], int(made.counts[window]))
    columns = strategies(window, depth, made.counts[:-1] > 0)
    repeats = np.rint(solve(columns, made.counts[:-1])).astype(np.int64)
    for i in np.argsort(-repeats, kind="stable")[: np.count_nonzero(repeats)]:
        parts = [int(n) for n in columns[i] if n]
        times = min(int(repeats[i]), min(int(made.counts[n]) // parts.count(n) for n in parts))
        if times:
            made.repeat([(n, n) for n in reversed(parts)], times)
    while made.tokens >= window:
        made.fill(window)
    left = made.tokens
    for power in range(left.bit_length() - 1, -1, -1):
        if left >> power & 1:
            made.fill(1 << power)
    return made


class Lookup:
    """The places of (bin, rank): stretches of ranks that all go the same way, each with one place or more."""

    def __init__(self, made: Plan):
        p = np.array(made.places, np.int64).reshape(-1, 7)
        bin_, first, count = p[:, 0], p[:, 1], p[:, 2]
        begin, end = self.key(bin_, first), self.key(bin_, first + count)
        self.cuts = np.unique(np.concatenate([begin, end]))
        a, b = np.searchsorted(self.cuts, begin), np.searchsorted(self.cuts, end)
        at, place = ragged(a, b - a), np.repeat(np.arange(len(p)), b - a)
        order = np.lexsort((p[place, 3], at))
        self.place = place[order]
        self.first = np.searchsorted(at[order], np.arange(len(self.cuts) + 1))
        self.rank, self.begin, self.use, self.sequence, self.offset = first, p[:, 3], p[:, 4], p[:, 5], p[:, 6]

    @staticmethod
    def key(bin_: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return (bin_.astype(np.int64) << 48) | rank

    def __call__(self, bin_: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, begin, use, sequence, offset) of every part of the given pieces."""
        at = np.searchsorted(self.cuts, self.key(bin_, rank), side="right") - 1
        n = self.first[at + 1] - self.first[at]
        row = np.repeat(np.arange(len(at)), n)
        place = self.place[ragged(self.first[at], n)]
        sequence = self.sequence[place] + rank[row] - self.rank[place]
        return row, self.begin[place], self.use[place], sequence, self.offset[place]


# --- the documents ----------------------------------------------------------------------


def _binary(values: np.ndarray, length: np.ndarray) -> pa.Array:
    """One binary value of little-endian unsigned 32-bit ids for each length."""
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(4 * length, out=offsets[1:])
    data = np.ascontiguousarray(values.astype("<u4"))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(length), buffers).cast(pa.binary())


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Whole windows and the rest of every document, with their rank among those of their length in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part = word_units(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            for some in W.pieces(batch, "text"):
                ids, tokens = units.encode(some.column("text"), end_id)
                n = -(-tokens // window)
                row = np.repeat(np.arange(len(n)), n)
                start = window * ragged(np.zeros(len(n), np.int64), n)
                length = np.minimum(tokens[row] - start, window)
                order = np.argsort(length, kind="stable")
                sorted_ = length[order]
                nth = np.empty(len(order), np.int64)
                nth[order] = seen[sorted_] + np.arange(len(order)) - np.searchsorted(sorted_, sorted_)
                seen += np.bincount(length, minlength=window + 1)
                found = {
                    "part": pa.array(np.full(len(row), part, np.int32)),
                    "doc_id": some.column("doc_id").take(pa.array(row)),
                    "start": pa.array(start),
                    "length": pa.array(length.astype(np.int32)),
                    "nth": pa.array(nth),
                    "doc_tokens": pa.array(tokens[row]),
                    "ids": _binary(ids, length),
                }
                yield pa.RecordBatch.from_pydict(found)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, PIECES)


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, depth: int = DEPTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every piece; no sequence is padded.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers, ``start`` the number of the
    document's ids before it, ``offset`` its place in its sequence.
    """
    cut = stage(pieces(docs, tokenizer, window, end_id), "pieces")
    cells = stage(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "cells")
    counts = np.zeros(window + 1, np.int64)
    for length, n in cells.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    lookup = Lookup(plan(counts, window, depth))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = cells.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranks = F.broadcast(ranks) if cells.count() <= SMALL_CELLS else ranks

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, len(whole), ROWS)):
                length = batch.column("length").to_numpy()
                row, begin, use, sequence, offset = lookup(length, batch.column("rank").to_numpy())
                flat = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u4")
                first = (np.cumsum(length, dtype=np.int64) - length)[row] + begin
                kept = batch.select(["doc_id", "start", "doc_tokens"]).take(pa.array(row))
                found = {
                    "doc_id": kept.column("doc_id"),
                    "start": pa.array(kept.column("start").to_numpy() + begin),
                    "length": pa.array(use),
                    "doc_tokens": kept.column("doc_tokens"),
                    "sequence_id": pa.array(sequence),
                    "offset": pa.array(offset),
                    "ids": _binary(flat[ragged(first, use)], use),
                }
                yield pa.RecordBatch.from_pydict(found)

    ranked = cut.join(ranks, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    return ranked.select("doc_id", "start", "length", "doc_tokens", "rank", "ids").mapInArrow(place, PLACED)
