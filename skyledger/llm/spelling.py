"""Words one letter apart, by a trie of letter counts, and the spelling that each of them is a variant of.

1. Letters are dealt into ``GROUPS`` groups, the frequent ones alone. A word is the vector of its counts in each. One
   inserted, deleted or replaced letter changes a vector by a surplus of one at most and a deficit of one at most.
2. Arranged by successive counts the words form a trie. It is cut into cells: the first nodes with ``CELL`` words or
   fewer, found level by level, so the prefixes vary in length. The cells' own trie, whose size is bounded by the
   share of all words that a cell may hold, goes to all tasks: a depth-first search that spends the budget of one
   surplus and one deficit sends each word to the cells where it may have near words.
3. In its cell the search goes on below, for all words that came there together: a node passes on those whose counts
   its branches allow. Where few words are left, or all counts are used, they are compared letter by letter.
   Words of two cells meet in the later one, so each pair is found once.
4. A word's form is its most frequent near word, if it is ``TIMES`` as frequent; roots follow forms to the last one, in
   rounds that double their reach. Forms grow by that factor, so chains are short.

Letters are those of Latin-1: ``[A-Za-z\\u00C0-\\u00FF]``. Null words and counts take no part; rows that repeat a word
are added up. Words may be of any length. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.encoders import ragged
from skyledger.session import stage

RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GROUPS = 20
# Words in a cell at most, unless that made more than CELLS cells a level.
CELL = 20_000
CELLS = 5_000
# Words that are compared rather than divided once more, and letters compared at once.
LEAF = 24
BLOCK = 1 << 21
TIMES = 5

WORDS = "word string, n long, vector array<int>"
VISITS = "cell int, word string, n long, at_home boolean"
NEAR = "a string, n_a long, b string, n_b long"


# --- words as arrays --------------------------------------------------------------


class Spelt:
    """Words as one array of Latin-1 letters."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        self.first = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join(raw), np.uint8)

    def vectors(self, group: np.ndarray) -> np.ndarray:
        """Counts of each word's letters by group."""
        row = np.repeat(np.arange(len(self.length)), self.length)
        cell = row * GROUPS + group[self.letters]
        return np.bincount(cell, minlength=len(self.length) * GROUPS).reshape(-1, GROUPS).astype(np.int32)

    def one_apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether words i and j differ by exactly one inserted, deleted or replaced letter."""
        swap = self.length[i] > self.length[j]
        short, long_ = np.where(swap, j, i), np.where(swap, i, j)
        apart = self.length[long_] - self.length[short]
        good = np.zeros(len(i), bool)
        at = np.flatnonzero(apart <= 1)
        ends = np.cumsum(self.length[short[at]])
        while len(at):
            take = max(1, int(np.searchsorted(ends, ends[0] - self.length[short[at[0]]] + BLOCK)))
            some, at, ends = at[:take], at[take:], ends[take:]
            good[some] = self._one_apart(short[some], long_[some], apart[some])
        return good

    def _one_apart(self, short: np.ndarray, long_: np.ndarray, apart: np.ndarray) -> np.ndarray:
        n = self.length[short]
        row = np.repeat(np.arange(len(n)), n)
        place = ragged(np.zeros(len(n), np.int64), n)
        letter = self.letters[ragged(self.first[short], n)]
        straight = letter != self.letters[ragged(self.first[long_], n)]
        # Without the one letter, what follows the first difference must be equal one place on.
        shifted = letter != self.letters[ragged(self.first[long_] + apart, n)]
        differing = np.bincount(row, straight, minlength=len(n))
        first = n.copy()
        np.minimum.at(first, row[straight], place[straight])
        last = np.full(len(n), -1)
        np.maximum.at(last, row[shifted], place[shifted])
        return np.where(apart == 1, last < first, differing == 1)


def letter_groups(letters: np.ndarray) -> np.ndarray:
    """The group of each letter by how often each occurs: the most frequent ones first and alone."""
    group = np.zeros(256, np.int64)
    rank = np.arange(len(letters))
    group[np.argsort(-letters, kind="stable")] = np.where(rank < GROUPS, rank, GROUPS - 1 - rank % GROUPS)
    return group


class Budget:
    """Words on their way down a trie, with the surplus and the deficit that each has already spent."""

    def __init__(self, at: np.ndarray, surplus: np.ndarray, deficit: np.ndarray):
        self.at, self.surplus, self.deficit = at, surplus, deficit

    @classmethod
    def fresh(cls, n: int) -> Budget:
        return cls(np.arange(n), np.zeros(n, bool), np.zeros(n, bool))

    def into(self, counts: np.ndarray, count: int) -> Budget:
        """Those that may go into the branch of ``count``; ``counts`` are their own."""
        more = counts[self.at] - count
        go = (more == 0) | ((more == 1) & ~self.surplus) | ((more == -1) & ~self.deficit)
        return Budget(self.at[go], self.surplus[go] | (more[go] == 1), self.deficit[go] | (more[go] == -1))


# --- cells -----------------------------------------------------------------------------


def vectors(words: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The words (word, n) with their vectors, and the group of each letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(Spelt(batch.column("word").to_pylist()).letters, minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["letter", "n"])

    letters = np.zeros(256, np.int64)
    for letter, n in words.select("word").mapInArrow(count, "letter long, n long").groupBy("letter").agg(F.sum("n")).collect():
        letters[letter] = n
    group = letter_groups(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Spelt(batch.column("word").to_pylist()).vectors(group)
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * GROUPS)
            lists = pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["word", "n", "vector"])

    return words.select("word", "n").mapInArrow(run, WORDS), group


def cells(rows: DataFrame, most: int = CELL) -> dict:
    """The trie of cells: branches by count, with the number of the cell where it ends.

    A level holds at most (all words / ``most``) nodes that must be divided, so the trie stays small.
    """
    total = rows.count()
    most = max(most, total // CELLS)
    if total <= most:
        return {"cell": 0}
    trie, n_cells, parents = {}, 0, {(): None}
    parents[()] = trie
    depth = 0
    while parents:
        depth += 1
        open_ = rows.sparkSession.createDataFrame([(list(p),) for p in parents], "parent array<int>")
        below = rows.select(F.slice("vector", 1, depth).alias("prefix"), F.slice("vector", 1, depth - 1).alias("parent"))
        counts = below.join(F.broadcast(open_), "parent", "left_semi").groupBy("prefix").agg(F.count("*").alias("n"))
        divided = {}
        for prefix, n in sorted((tuple(r.prefix), r.n) for r in counts.collect()):
            node = parents[prefix[:-1]].setdefault(prefix[-1], {})
            if n <= most or depth == GROUPS:
                node["cell"] = n_cells
                n_cells += 1
            else:
                divided[prefix] = node
        parents = divided
    return trie


def visits(rows: DataFrame, trie: dict) -> DataFrame:
    """(cell, word, n, at_home): every word in its own cell, and in each later one that may hold a near word."""

    def search(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        stack, out = [(trie, 0, Budget.fresh(len(found)))], []
        while stack:
            node, depth, words = stack.pop()
            if "cell" in node:
                out.append((words.at, np.full(len(words.at), node["cell"]), ~words.surplus & ~words.deficit))
                continue
            for count, child in node.items():
                into = words.into(found[:, depth], count)
                if len(into.at):
                    stack.append((child, depth + 1, into))
        at, cell, exact = (np.concatenate(x) for x in zip(*out))
        home = np.zeros(len(found), np.int64)
        home[at[exact]] = cell[exact]
        keep = exact | (cell > home[at])
        return at[keep], cell[keep], exact[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                found = batch.column("vector").flatten().to_numpy().reshape(-1, GROUPS)
                at, cell, home = search(found)
                words = batch.select(["word", "n"]).take(pa.array(at))
                columns = [pa.array(cell.astype(np.int32)), *words.columns, pa.array(home)]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "word", "n", "at_home"])

    return rows.mapInArrow(run, VISITS)


# --- the search in a cell --------------------------------------------------------------


def near_in_cell(spelt: Spelt, found: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (any word, word at home) that are one letter apart; two words at home are given once."""
    members = np.flatnonzero(home)
    members = members[np.lexsort(found[members].T[::-1])]
    sorted_ = found[members]
    stack, out = [(0, len(members), 0, Budget.fresh(len(found)))], []

    def compare(low: int, high: int, words: np.ndarray) -> None:
        step = max(1, BLOCK // ((high - low) * GROUPS))
        for some in (words[i : i + step] for i in range(0, len(words), step)):
            i, j = np.repeat(some, high - low), np.tile(members[low:high], len(some))
            once = (i != j) & (~home[i] | (i < j))
            i, j = i[once], j[once]
            apart = found[i] - found[j]
            close = (np.maximum(apart, 0).sum(axis=1) <= 1) & (np.maximum(-apart, 0).sum(axis=1) <= 1)
            i, j = i[close], j[close]
            good = spelt.one_apart(i, j)
            out.append((i[good], j[good]))

    while stack:
        low, high, depth, words = stack.pop()
        if high - low <= LEAF or depth == GROUPS:
            compare(low, high, words.at)
            continue
        column = sorted_[low:high, depth]
        cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
        for a, b in zip(cuts, cuts[1:]):
            into = words.into(found[:, depth], int(column[a]))
            if len(into.at):
                stack.append((low + a, low + b, depth + 1, into))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def near_pairs(words: DataFrame, most: int = CELL) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of the distinct words (word, n) that are one letter apart, each once."""
    rows, group = vectors(words)
    rows = stage(rows, "vectors")
    trie = cells(rows, most)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        spelt = Spelt(table.column("word").to_pylist())
        i, j = near_in_cell(spelt, spelt.vectors(group), table.column("at_home").to_numpy())
        words = table.select(["word", "n"])
        left, right = words.take(pa.array(i)), words.take(pa.array(j))
        return pa.Table.from_arrays([*left.columns, *right.columns], ["a", "n_a", "b", "n_b"])

    return visits(rows, trie).groupBy("cell").applyInArrow(run, NEAR)


# --- forms and roots --------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        now = step.drop("next")
        if step.where("next IS NOT NULL").isEmpty():
            return now


def grouped(words: DataFrame, most: int = CELL, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words with their counts (word, n)."""
    words = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = stage(words, "words")
    pairs = stage(near_pairs(words, most), "near")
    near = pairs.select(F.col("a").alias("word"), "n_a", F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "n_b", "a", "n_a")
    )
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"), F.first("n_a").alias("n")
    )
    is_form = -F.col("best.col1") >= times * F.col("n")
    best = stage(
        best.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.col1")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(best.where("form IS NOT NULL").select("word", "form"))
    return (
        words.join(best, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
    )


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of letters of every text, A-Z in lower case."""
    lower = F.translate(F.col("text").cast("string"), UPPER, UPPER.lower())
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
