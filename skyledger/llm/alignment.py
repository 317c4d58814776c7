"""Two tokenizers' tokens of the same texts, aligned by their bytes.

Every text is encoded whole by both: A (byte-level pairs) gets a space and the text, B (sentence pieces) adds the
space itself. If the tokens of each, joined, are the bytes of space and text, offsets in them mean the same place.

1. Places where a token that begins with a space starts in A and in B alike are anchors; they are shared ends of
   what lies before. They split a text into windows of a few ids of each, mostly a word.
2. A window's alignment depends on its ids alone, so it is done once for each pair of id tuples that a worker meets
   and remembered. Ends that A and B share cut a window into groups; the two tokens at a shared end are a link.
3. Links are counted over the corpus by pairs of ids. Each text's links look up these counts: pairs with at least
   1 / HOT of all links, which cannot be more than HOT, in a broadcast table; the others by a join, in which no pair
   has more than 1 / HOT of the rows.

Texts that are null, empty, or whose tokens don't give back their bytes have no tokens: counts are 0, groups are ''.
Rows that repeat an id, null ids included, keep rows of their own. Texts without anchors are one long window. An
empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.encoders import BytePairs, Pieces, TokenBytes, ragged
from skyledger.session import stage

# Pairs of ids with more than 1 / HOT of all links are looked up in a broadcast table of at most HOT rows (2 MB).
HOT = 100_000
# Windows that a worker remembers, besides those of the piece at hand: some 60 MB.
REMEMBERED = 1_000_000
# Bytes of text aligned at once.
PIECE = 1 << 20

DIGEST = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups string"
ALIGNED = f"{DIGEST}, pairs array<long>, times array<long>"
SCORED = f"{DIGEST}, n_best long, count_sum long, pairs array<long>, times array<long>"


@dataclass
class Encoded:
    """The tokens of many texts, one after the other; texts without tokens have none of either."""

    a: np.ndarray  # ids
    b: np.ndarray
    n_a: np.ndarray  # tokens of each text
    n_b: np.ndarray
    ends: np.ndarray  # bytes up to the end of each text


class Aligner:
    """Encodes and aligns texts, and remembers windows.

    A window is known by 64 bits of hash of both id tuples; of a million windows, two share one in 30 million cases.
    Remembered are the ends of its groups, as numbers of A and of B tokens from its start.
    """

    def __init__(self, path_a: str, path_b: str):
        self.of_a, self.of_b = BytePairs(path_a), Pieces(path_b)
        self.digits = TokenBytes([str(i).encode() for i in range(max(len(self.of_a.bytes.length), len(self.of_b.bytes.length)))])
        self._forget()

    def _forget(self) -> None:
        self.known, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ends_a, self.ends_b = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def encoded(self, texts: list[str | None]) -> Encoded:
        whole = [f" {t}" if t else "" for t in texts]
        raw = [t.encode() for t in whole]
        size = np.array([len(r) for r in raw], np.int64)
        wanted = np.frombuffer(b"".join(raw), np.uint8)
        good = size > 0
        found = []
        for vocabulary, given in ((self.of_a, whole), (self.of_b, [t or "" for t in texts])):
            ids = vocabulary.encode(given)
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.concatenate([*ids, np.zeros(0, np.int32)])
            good &= _gives_back(vocabulary.bytes, flat, n, wanted, size)
            found.append((flat, n))
        if not good.all():
            found = [(flat[np.repeat(good, n)], np.where(good, n, 0)) for flat, n in found]
        (a, n_a), (b, n_b) = found
        return Encoded(a, b, n_a, n_b, np.cumsum(np.where(good, size, 0)))

    def windows(self, e: Encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First A token and first B token of each window, with the totals at the end, and the text of each."""
        bytes_a, bytes_b = self.of_a.bytes, self.of_b.bytes
        start_a = np.cumsum(bytes_a.length[e.a]) - bytes_a.length[e.a]
        start_b = np.cumsum(bytes_b.length[e.b]) - bytes_b.length[e.b]
        marked_a, marked_b = np.flatnonzero(bytes_a.spaced[e.a]), np.flatnonzero(bytes_b.spaced[e.b])
        _, of_a, of_b = np.intersect1d(start_a[marked_a], start_b[marked_b], assume_unique=True, return_indices=True)
        first_a, first_b = marked_a[of_a], marked_b[of_b]
        row = np.searchsorted(e.ends, start_a[first_a], side="right")
        return np.append(first_a, len(e.a)), np.append(first_b, len(e.b)), row

    def _align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, ...]:
        """The number of groups of each window, and the ends of all groups, in tokens from their window's start."""
        end_a, end_b = np.cumsum(self.of_a.bytes.length[a]), np.cumsum(self.of_b.bytes.length[b])
        # Windows are as long in A as in B, so bytes before a window are the same in both.
        _, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        window = np.searchsorted(upto_a, at_a, side="right")
        return (
            np.bincount(window, minlength=len(n_a)),
            (at_a + 1 - (upto_a - n_a)[window]).astype(np.int32),
            (at_b + 1 - (upto_b - n_b)[window]).astype(np.int32),
        )

    def _learn(self, keys: np.ndarray, *window: np.ndarray) -> None:
        n, ends_a, ends_b = self._align(*window)
        at = np.append(self.at, np.arange(len(self.first) - 1, len(self.first) - 1 + len(n)))
        known = np.append(self.known, keys)
        order = np.argsort(known, kind="stable")
        self.known, self.at = known[order], at[order]
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n)])
        self.ends_a, self.ends_b = np.concatenate([self.ends_a, ends_a]), np.concatenate([self.ends_b, ends_b])

    def places(self, e: Encoded, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        """Where the alignment of each window lies; windows that are not known yet are aligned."""
        hashes = (W.range_hashes(ids, at[:-1], at[1:]) for ids, at in ((e.a, at_a), (e.b, at_b)))
        codes, keys = pd.factorize(W.mix(next(hashes)) + next(hashes))
        if len(self.known):
            is_known = self.known[np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)] == keys
        else:
            is_known = np.zeros(len(keys), bool)
        new = np.flatnonzero(~is_known)
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = np.arange(len(keys))
        if len(new):
            some = np.zeros(len(keys), np.int64)
            some[codes] = np.arange(len(codes))
            some = some[new]
            n_a, n_b = np.diff(at_a)[some], np.diff(at_b)[some]
            self._learn(keys[new], e.a[ragged(at_a[some], n_a)], n_a, e.b[ragged(at_b[some], n_b)], n_b)
        return self.at[np.searchsorted(self.known, keys)][codes]

    def _shown(self, e: Encoded, end_a: np.ndarray, end_b: np.ndarray, n: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each text; a text has the next n groups, which end before the given tokens."""
        n_a, n_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        # Places of the tokens in the text: each group's A tokens, then its B tokens.
        group_start = np.cumsum(n_a + n_b) - n_a - n_b
        place_a, place_b = ragged(group_start, n_a), ragged(group_start + n_a, n_b)
        ids = np.empty(len(e.a) + len(e.b), np.int32)
        ids[place_a], ids[place_b] = e.a, e.b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[group_start + n_a - 1], mark[group_start + n_a + n_b - 1] = ord("|"), ord(";")
        length = self.digits.length[ids]
        upto = np.cumsum(length + 1)
        out = np.empty(int(upto[-1]) if len(upto) else 0, np.uint8)
        out[upto - 1] = mark
        written = np.ones(len(out), bool)
        written[upto - 1] = False
        out[written] = self.digits.joined(ids)
        tokens = np.concatenate([[0], np.cumsum(n_a + n_b)])[np.concatenate([[0], np.cumsum(n)])]
        cuts = np.concatenate([[0], upto])[tokens].tolist()
        raw = out.tobytes()
        return [raw[i : j - 1] if j > i else b"" for i, j in zip(cuts, cuts[1:])]

    def aligned(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """What each text has: numbers of tokens, groups and links, its groups as text, distinct links and their times."""
        e = self.encoded(texts)
        at_a, at_b, row = self.windows(e)
        at = self.places(e, at_a, at_b)
        groups = self.first[at + 1] - self.first[at]
        place = ragged(self.first[at], groups)
        end_a = np.repeat(at_a[:-1], groups) + self.ends_a[place]
        end_b = np.repeat(at_b[:-1], groups) + self.ends_b[place]
        of = np.repeat(row, groups)
        n = np.bincount(of, minlength=len(texts))
        links = e.a[end_a - 1].astype(np.int64) << 32 | e.b[end_b - 1]
        codes, distinct = pd.factorize(links)
        both, times = np.unique(of * max(len(distinct), 1) + codes, return_counts=True)
        of, codes = both // max(len(distinct), 1), both % max(len(distinct), 1)
        return {
            "n_a": e.n_a,
            "n_b": e.n_b,
            "n_links": n,
            "groups": self._shown(e, end_a, end_b, n),
            "pairs": distinct[codes],
            "times": times,
            "distinct": np.bincount(of, minlength=len(texts)),
        }


def _gives_back(tokens, ids: np.ndarray, n: np.ndarray, wanted: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each text, whether its tokens' bytes, joined, are the wanted ones."""
    row = np.repeat(np.arange(len(n)), n)
    length = np.bincount(row, tokens.length[ids], minlength=len(n)).astype(np.int64)
    same = length == size
    joined = tokens.joined(ids)[np.repeat(same, length)]
    differs = joined != wanted[np.repeat(same, size)]
    return same & (np.bincount(np.repeat(np.arange(len(n)), np.where(same, size, 0)), differs, minlength=len(n)) == 0)


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The vocabularies and windows of this worker, which serves one task after the other."""
    return Aligner(path_a, path_b)


def _lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(n) + 1, np.int32)
    np.cumsum(n, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """(doc_id, row, n_a, n_b, n_groups, n_links, groups, pairs, times) of every text.

    ``groups`` is ``a1,a2|b1;a3|b2`` in ids, or with ``digest`` its SHA-256; ``pairs`` are the distinct links, A's id
    in the upper and B's in the lower 32 bits, ``times`` how often each occurs, ``row`` a number of its own.
    """

    def shown(groups: bytes) -> str:
        return hashlib.sha256(groups).hexdigest() if digest and groups else groups.decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row = aligner(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in W.pieces(batch, "text", PIECE):
                found = both.aligned(piece.column("text").to_pylist())
                n = len(piece)
                columns = [
                    piece.column("doc_id"),
                    np.arange(row, row + n),
                    found["n_a"],
                    found["n_b"],
                    found["n_links"],
                    found["n_links"],
                    pa.array([shown(groups) for groups in found["groups"]], pa.string()),
                    _lists(found["pairs"], found["distinct"]),
                    _lists(found["times"], found["distinct"]),
                ]
                names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)
                row += n

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): links of each pair over all texts, and whether no pair with the same B id has more."""
    each = rows.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    # A window holds the A ids seen with one B id: never more than A has.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_b))


def _hot_scores(rows: DataFrame, hot: np.ndarray, count: np.ndarray, best: np.ndarray) -> DataFrame:
    """The rows with what their hot pairs add up to; the other pairs stay listed."""
    names = [f.split()[0] for f in DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.compute.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            pair, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            at = np.minimum(np.searchsorted(hot, pair), max(len(hot) - 1, 0))
            known = hot[at] == pair if len(hot) else np.zeros(len(pair), bool)
            sums = []
            for worth in (best, count):
                upto = np.zeros(len(pair) + 1, np.int64)
                np.cumsum(np.where(known, worth[at] if len(hot) else 0, 0) * times, out=upto[1:])
                ends = np.cumsum(n)
                sums.append(pa.array(upto[ends] - upto[ends - n]))
            left = np.bincount(row[~known], minlength=len(n))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, *sums, _lists(pair[~known], left), _lists(times[~known], left)],
                [*names, "n_best", "count_sum", "pairs", "times"],
            )

    return rows.mapInArrow(run, SCORED)


def scored(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every text.

    ``n_best`` counts the links whose pair is the most frequent of its B id in the corpus, ties included;
    ``count_sum`` adds up the corpus counts of all links.
    """
    rows = stage(aligned(docs, path_a, path_b, digest), "aligned")
    counts = stage(pair_counts(rows), "pairs")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * hot >= total
    top = counts.where(is_hot).orderBy("pair").toPandas()
    some = stage(
        _hot_scores(rows, top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(np.int64)),
        "scored",
    )
    rare = (
        some.select("row", F.inline(F.arrays_zip("pairs", "times")))
        .join(counts.where(~is_hot), F.col("pairs") == F.col("pair"))
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("n")).alias("rare_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("rare_best"))
    )
    plus = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).alias(x)
    return some.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "rare_best"), plus("count_sum", "rare_sum"), "groups"
    )
