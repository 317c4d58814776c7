"""Benchmark decontamination with spaced seeds that lose nothing the rule accepts.

An overlap is a stretch of one diagonal (the item laid over the document at one place) with min(``least_tokens``,
80 % of the item) equal tokens or more, and at least 80 % of it equal. The valid stretch with the most equal tokens
is reported, from its first equal token to its last.

A seed is a mask over consecutive tokens; the tokens at its zeros are ignored. All masks have four ones. By the
pigeonhole principle 13 or more equal tokens with at most a fifth of the stretch changed hold four equal ones in a
row, so ``1111`` finds every overlap of items of 16 or more tokens. Of shorter ones, those of 5, 6, 7, 10, 11 and 15
tokens can have overlaps without four in a row, and get masks with one gap as well. The hashes of the seeds at all
places of the benchmark are looked up in those of every document. Each hit names a diagonal, on which all tokens are
compared. Before its stretches are looked at it must hold enough equal tokens, and, where 13 are needed, 13
consecutive places with at most 5 changed, which every valid stretch of 13 or more places has.

Texts are lower-cased; tokens are runs of ASCII letters, digits and all non-ASCII characters; so ASCII quotes and punctuation
do not matter. Inserted or left out tokens end a diagonal. Items with fewer than ``shortest_item`` tokens (4) can't be
told from chance and are not looked for.

The benchmark is cut into slices of bounded size by item; each slice's hashes go to all tasks, and documents are
scanned once for each slice. Documents are never shuffled.

Null texts on either side have no tokens. Repeated items and documents give repeated hits of the same ids, which
are reported once for each (doc_id, item_id). Rows with a null doc_id or item_id are not reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.tables import drop_ids
from skyledger.session import stage


@dataclass(frozen=True)
class Seeds:
    masks: tuple[str, ...] = ("1111", "11101", "11011", "10111")
    least_tokens: int = 13
    share: float = 0.8
    shortest_item: int = 4
    # Benchmark bytes in one slice: its seeds take about 30 times that in a task.
    slice_bytes: int = 1 << 20
    # Hits, and tokens on their diagonals, that are held at once.
    block: int = 1 << 20

    @property
    def per_mille(self) -> int:
        return round(1000 * self.share)

    def least(self, length: np.ndarray) -> np.ndarray:
        """Equal tokens that an item of this length needs."""
        return np.minimum(self.least_tokens, -(-length * self.per_mille // 1000))

    def least_run(self, length: int) -> int:
        """Equal tokens in a row that every overlap with an item of this length has."""
        need, p = int(self.least(np.int64(length))), self.per_mille
        # The fewest equal tokens around so many changed ones.
        equal = ((c, max(need, -(-c * p // (1000 - p)))) for c in range(length))
        return min(-(-e // (c + 1)) for c, e in equal if e + c <= length)


def _masked(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked window that starts at each place."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, int(mask, 2), np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            out = W.mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return out


def _rows_whole(row: np.ndarray, span: int) -> np.ndarray:
    return row[span - 1 :] == row[: len(row) - span + 1] if len(row) >= span else np.zeros(0, bool)


@dataclass
class Index:
    """Seeds of one slice of the benchmark: item i has tokens[first[i]:first[i + 1]]."""

    ids: np.ndarray
    tokens: np.ndarray
    first: np.ndarray
    seeds: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]  # mask: hash, item, place, by hash


def index_of(ids: list[int], texts: list[str | None], conf: Seeds) -> Index:
    words = W.split_words(pa.array(texts, pa.string()), W.PUNCTUATION)
    h, count, first = W.word_hashes(words), words.per_row(), words.first_of_row()
    seeds = {}
    gapped = np.isin(count, [n for n in np.unique(count) if n >= conf.shortest_item and conf.least_run(int(n)) < 4])
    for mask in conf.masks:
        at = np.flatnonzero(_rows_whole(words.row, len(mask)))
        wanted = gapped if "0" in mask else count >= conf.shortest_item
        at = at[wanted[words.row[at]]]
        key = _masked(h, mask)[at]
        order = np.argsort(key, kind="stable")
        at = at[order]
        seeds[mask] = key[order], words.row[at], at - first[words.row[at]]
    return Index(np.array(ids, np.int64), h, first, seeds)


def largest_stretch(equal: np.ndarray, conf: Seeds) -> tuple[int, int, int]:
    """Start, end and equal tokens of the stretch with the most equal tokens of those with the share of them (the
    first of several), without changed tokens at its ends."""
    p = conf.per_mille
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1000 - p, -p))])
    total = np.concatenate([[0], np.cumsum(equal)])
    # A stretch has the share if the score does not fall over it; the longest one to each end starts at the first
    # place with no larger score.
    start = np.searchsorted(-np.minimum.accumulate(score), -score)
    n = total - total[start]
    end = int(np.argmax(n))
    x = int(start[end])
    at = np.flatnonzero(equal[x:end])
    return (x + int(at[0]), x + int(at[-1]) + 1, len(at)) if len(at) else (x, x, 0)


def _blocks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of places whose sizes have about ``limit`` together."""
    if len(sizes):
        group = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(sizes)]
        yield from zip(cuts, cuts[1:])


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of n[0] places, then those of start[1], and so on."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _verified(hits: np.ndarray, h: np.ndarray, first: np.ndarray, index: Index, conf: Seeds) -> Iterator[tuple[int, int, int, int, int]]:
    """The overlaps on the diagonals (row, item, start)."""
    row, item, start = hits.T
    length = index.first[item + 1] - index.first[item]
    a = np.maximum(0, -start)
    n = np.minimum(length, first[row + 1] - first[row] - start) - a
    need = conf.least(length)
    mine, theirs = first[row] + start + a, index.first[item] + a
    wide = conf.least_tokens
    # Of a stretch cut into such widths, one part has less than twice the changed share.
    changed = max(0, -(-2 * wide * (1000 - conf.per_mille) // 1000) - 1)
    for i, j in _blocks(n, conf.block):
        equal = h[_ranges(mine[i:j], n[i:j])] == index.tokens[_ranges(theirs[i:j], n[i:j])]
        sums = np.concatenate([[0], np.cumsum(equal)])
        begin = np.cumsum(n[i:j]) - n[i:j]
        for k in np.flatnonzero(sums[begin + n[i:j]] - sums[begin] >= need[i:j]):
            here = equal[begin[k] : begin[k] + n[i + k]]
            part = sums[begin[k] : begin[k] + n[i + k] + 1]
            if need[i + k] == wide and (part[wide:] - part[:-wide]).max() < wide - changed:
                continue
            x, y, same = largest_stretch(here, conf)
            if same >= need[i + k]:
                yield int(row[i + k]), int(item[i + k]), int(start[i + k] + a[i + k] + x), y - x, same


def overlaps(texts: pa.Array, index: Index, conf: Seeds) -> list[tuple[int, int, int, int, int]]:
    """(row, item, first token in the row, tokens, equal tokens) of each verified overlap."""
    words = W.split_words(texts, W.PUNCTUATION)
    h, first = W.word_hashes(words), words.first_of_row()
    found = set()
    for mask, (keys, items, places) in index.seeds.items():
        if not len(keys) or len(h) < len(mask):
            continue
        probe = _masked(h, mask)
        known = np.zeros(1 << 20, bool)
        known[keys & np.uint64((1 << 20) - 1)] = True
        maybe = np.flatnonzero(known[probe & np.uint64((1 << 20) - 1)] & _rows_whole(words.row, len(mask)))
        a, b = (np.searchsorted(keys, probe[maybe], side) for side in ("left", "right"))
        n = b - a
        for i, j in _blocks(n, conf.block):
            at, seed = np.repeat(maybe[i:j], n[i:j]), _ranges(a[i:j], n[i:j])
            hits = np.stack([words.row[at], items[seed], at - places[seed] - first[words.row[at]]], axis=1)
            found.update(_verified(np.unique(hits, axis=0), h, first, index, conf))
    return sorted(found)


SCHEMA = "doc_id long, item_id long, first_token long, n_tokens long, n_equal long"


def _scan(docs: DataFrame, index: Index, conf: Seeds) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                found = overlaps(piece.column("text"), index, conf)
                if found:
                    row, item, *rest = (np.array(x, np.int64) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id").take(pa.array(row)), *map(pa.array, (index.ids[item], *rest))],
                        ["doc_id", "item_id", "first_token", "n_tokens", "n_equal"],
                    )

    return docs.mapInArrow(run, SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, conf: Seeds = Seeds()) -> DataFrame:
    """One row for each document and benchmark item that it holds: the largest overlap, the first of several."""
    docs = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")
    )
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = total // conf.slice_bytes + 1
    found = []
    for k in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k).collect()
        index = index_of([r.item_id for r in rows], [r.text for r in rows], conf)
        found.append(_scan(docs, index, conf))
    best = F.max_by(F.struct("first_token", "n_tokens", "n_equal"), F.struct("n_equal", -F.col("first_token")))
    hits = reduce(DataFrame.union, found).groupBy("doc_id", "item_id").agg(best.alias("best"))
    return hits.select("doc_id", "item_id", "best.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, conf: Seeds = Seeds()) -> DataFrame:
    """The documents, with all columns, that hold no benchmark item. Rows with a null doc_id stay."""
    bad = stage(contaminated(docs, benchmark, conf).select("doc_id").distinct(), "contaminated")
    return drop_ids(docs, bad)
