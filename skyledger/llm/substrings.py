"""Removal of repeated passages with prefix-partitioned suffix groups.

A window is ``window`` consecutive words of one document. A window is repeated if its words also start somewhere in
a document with a smaller doc_id; every word covered by a repeated window goes. Windows are judged on the input.

Suffixes are sparse: of all suffixes only those count that start at the smallest hash of a ``prefix``-word run within
some window (the leftmost of several). Equal windows have their smallest run at the same place, so they belong to
suffixes with the same prefix, and each window belongs to one suffix. Suffixes are partitioned by the hash of that
prefix; those of one prefix form a subtree, whose nodes at depth ``window`` are the windows the suffixes carry, as
hashes. A node with suffixes of two documents is a maximal repeat's part; runs of consecutive windows join to one.

Prefixes have variable length: a subtree of more than ``memory_rows`` suffixes is not worked on in one task but split
by the whole window, i.e. a prefix of ``window`` words, with sums of few values per window before any shuffle.
Smaller subtrees are worked on where their suffixes meet, a stream of sorted rows at a time.

Equality is that of 64 bits of the prefix and 64 bits of the window together.

Words are runs other than space and 0x09-0x0D. Null and empty texts, and texts shorter than a window, keep all
words. Rows with the same doc_id do not remove words of each other. Rows with a null doc_id lose nothing and remove
nothing. Equal rows get equal results. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.session import stage


@dataclass(frozen=True)
class Repeats:
    window: int = 50
    prefix: int = 16
    memory_rows: int = 50_000


def _leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value among values[i:i + width] for each i, the first of several."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def suffixes(texts: pa.Array, conf: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse suffixes: (row, prefix hash, place of the first window, number of windows, hashes of all windows)."""
    words = W.split_words(texts)
    h, first = W.word_hashes(words), words.first_of_row()
    n = len(h) - conf.window + 1
    whole = words.row[conf.window - 1 :] == words.row[: max(n, 0)] if n > 0 else np.zeros(0, bool)
    if not whole.any():
        return (np.zeros(0, np.int64),) * 5
    runs = W.range_hashes(h, np.arange(len(h) - conf.prefix + 1), np.arange(conf.prefix, len(h) + 1))
    anchor = _leftmost_smallest(runs, conf.window - conf.prefix + 1)[:n]
    at = np.flatnonzero(whole)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(at) > 1) | (anchor[at[1:]] != anchor[at[:-1]]) | (words.row[at[1:]] != words.row[at[:-1]])
    begin = np.flatnonzero(fresh)
    count = np.diff(np.append(begin, len(at)))
    start = at[begin]
    row = words.row[start]
    windows = W.signed(W.range_hashes(h, at, at + conf.window))
    return row, W.signed(runs[anchor[start]]), start - first[row], count, windows


def _narrow(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, text): the key stands for the text of the row."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("row_key"), text.alias("text"))


def suffix_rows(docs: DataFrame, conf: Repeats) -> DataFrame:
    """(prefix, doc_id, row_key, place, windows) of every sparse suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                row, prefix, place, count, windows = suffixes(piece.column("text"), conf)
                ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(windows))
                ids, keys = (piece.column(c).take(pa.array(row)) for c in ("doc_id", "row_key"))
                yield pa.RecordBatch.from_arrays([pa.array(prefix), ids, keys, pa.array(place.astype(np.int32)), lists], names)

    names = ["prefix", "doc_id", "row_key", "place", "windows"]
    schema = "prefix long, doc_id long, row_key long, place int, windows array<long>"
    return _narrow(docs.where("doc_id IS NOT NULL")).mapInArrow(run, schema)


def large_subtrees(docs: DataFrame, conf: Repeats) -> DataFrame:
    """(prefix) of the subtrees with more suffixes than one task shall hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                prefix, n = np.unique(suffixes(piece.column("text"), conf)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(prefix), pa.array(n)], ["prefix", "n"])

    counts = _narrow(docs.where("doc_id IS NOT NULL")).mapInArrow(run, "prefix long, n long")
    return counts.groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > conf.memory_rows).select("prefix")


def _repeated(table: pa.Table, window: int) -> pa.RecordBatch:
    """Word ranges (row_key, start, end) of the repeated windows among the suffixes of whole subtrees."""
    prefix, doc, key, place = (table.column(c).to_numpy() for c in ("prefix", "doc_id", "row_key", "place"))
    lists = table.column("windows").combine_chunks()
    count = np.diff(lists.offsets.to_numpy())
    # Subtrees of one document can't repeat anything of a smaller one.
    group = np.cumsum(np.concatenate([[True], prefix[1:] != prefix[:-1]])) - 1 if len(prefix) else prefix
    begin = np.flatnonzero(np.concatenate([[True], np.diff(group) > 0])) if len(group) else group
    several = np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin) if len(begin) else np.zeros(0, bool)
    rows = np.flatnonzero(several[group]) if len(group) else np.zeros(0, np.int64)
    n = count[rows]
    of = np.repeat(rows, n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    values = lists.values.to_numpy()[lists.offsets.to_numpy()[of] + nth]
    order = np.lexsort((doc[of], values, group[of]))
    of, nth, values = of[order], nth[order], values[order]
    fresh = np.ones(len(of), bool)
    fresh[1:] = (group[of[1:]] != group[of[:-1]]) | (values[1:] != values[:-1])
    smallest = doc[of[np.flatnonzero(fresh)]][np.cumsum(fresh) - 1] if len(of) else doc[:0]
    bad = doc[of] > smallest
    of, at = of[bad], place[of[bad]] + nth[bad]
    # Windows that follow each other in a row join to one range.
    order = np.lexsort((at, of))
    of, at = of[order], at[order]
    starts = np.ones(len(of), bool)
    starts[1:] = (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(of))[: len(first)] - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(key[of[first]]), pa.array(at[first].astype(np.int32)), pa.array((at[last] + window).astype(np.int32))],
        ["row_key", "start", "end"],
    )


RANGES = "row_key long, start int, end int"


def in_memory(rows: DataFrame, conf: Repeats) -> DataFrame:
    """Repeats of subtrees that fit a task: rows meet by prefix, sorted, and go through in whole subtrees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            prefix = batch.column("prefix").to_numpy()
            if not len(prefix):
                continue
            # The last subtree of a batch may go on in the next one.
            cut = int(np.searchsorted(prefix, prefix[-1]))
            if cut or (held and held[-1].column("prefix")[-1].as_py() != prefix[-1]):
                yield _repeated(pa.Table.from_batches([*held, batch.slice(0, cut)]), conf.window)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield _repeated(pa.Table.from_batches(held), conf.window)

    return rows.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(run, RANGES)


def split_large(rows: DataFrame, conf: Repeats) -> DataFrame:
    """Repeats of large subtrees, by window instead of by prefix."""
    windows = rows.select("prefix", "doc_id", "row_key", F.posexplode("windows").alias("nth", "value"), "place")
    keys = ["prefix", "value"]
    smallest = stage(
        windows.groupBy(*keys).agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest")).where("smallest < largest"),
        "windows",
    )
    bad = windows.join(smallest, keys).where("doc_id > smallest")
    start = F.col("place") + F.col("nth")
    return bad.select("row_key", start.alias("start"), (start + conf.window).alias("end"))


def repeated_ranges(docs: DataFrame, conf: Repeats = Repeats()) -> DataFrame:
    """(row_key, ranges): the word ranges of each row that repeat a document with a smaller id; they may overlap."""
    rows = suffix_rows(docs, conf)
    large = stage(large_subtrees(docs, conf), "large")
    if large.isEmpty():
        found = in_memory(rows, conf)
    else:
        found = in_memory(rows.join(large, "prefix", "left_anti"), conf).union(
            split_large(rows.join(large, "prefix", "left_semi"), conf)
        )
    return found.distinct().groupBy("row_key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))


def kept_words(texts: pa.Array, ranges: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of each row: words, removed words, and the kept ones joined by one space."""
    words = W.split_words(texts)
    first = words.first_of_row()
    lists = pa.compute.fill_null(pa.compute.list_value_length(ranges), 0).to_numpy(zero_copy_only=False)
    flat = pa.compute.list_flatten(ranges)
    marks = np.zeros(len(words.row) + 1, np.int64)
    base = np.repeat(first[:-1], lists)
    np.add.at(marks, base + flat.field("start").to_numpy(zero_copy_only=False), 1)
    np.add.at(marks, base + flat.field("end").to_numpy(zero_copy_only=False), -1)
    kept = np.flatnonzero(np.cumsum(marks)[:-1] == 0)
    # The bytes of each kept word and the separator after it, which becomes a space.
    data = np.append(np.where(W.SPACE[words.data], np.uint8(32), words.data), np.uint8(32))
    edges = np.zeros(len(data) + 1, np.int8)
    edges[words.start[kept]] += 1
    last = np.isin(words.end[kept], words.offsets[1:])
    edges[words.end[kept] + ~last] -= 1
    out = data[np.cumsum(edges)[:-1] > 0]
    width = np.bincount(words.row[kept], (words.end - words.start)[kept] + ~last, minlength=words.rows).astype(np.int64)
    ends = np.cumsum(width)
    joined = [out[e - w : e].tobytes() for e, w in zip(ends, width)]
    # A space is left over where the last kept word is not the row's last bytes.
    joined = [x[:-1] if x.endswith(b" ") else x for x in joined]
    n = words.per_row()
    return n, n - np.bincount(words.row[kept], minlength=words.rows), joined


def deduplicated(docs: DataFrame, conf: Repeats = Repeats()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without its repeated passages."""
    return _applied(docs, conf, "kept string", lambda texts: [x.decode() for x in texts])


def digests(docs: DataFrame, conf: Repeats = Repeats()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): as ``deduplicated``, with the hash of the kept words."""
    return _applied(docs, conf, "kept_sha256 string", lambda texts: [hashlib.sha256(x).hexdigest() for x in texts])


def _applied(docs: DataFrame, conf: Repeats, column: str, show) -> DataFrame:
    ranges = repeated_ranges(docs, conf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                n, removed, texts = kept_words(piece.column("text"), piece.column("ranges"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n), pa.array(removed), pa.array(show(texts), pa.string())],
                    ["doc_id", "n_words", "n_removed", column.split()[0]],
                )

    rows = _narrow(docs).join(ranges, "row_key", "left").select("doc_id", "text", "ranges")
    return rows.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {column}")
