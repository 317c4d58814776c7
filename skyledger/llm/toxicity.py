"""A toxicity classifier whose scores must not move when a neutral mention of a group is swapped for another.

Logistic regression on the distinct words of a text (lower-cased runs of ASCII letters, digits and non-ASCII
characters, by 64-bit hash). Training texts that mention an identity term get a counterfactual: each term replaced by
the next one of its group. The loss adds ``fairness`` times the squared difference of both logits, so the model
can't use the terms themselves, which lowers false positives on neutral mentions.

Labels are learnt from a bounded sample: at most about ``most_rows`` labelled rows, those with the smallest hash of
their id. Its words, too, are bounded in what reaches the driver: distinct hashes per text, of ``most_words`` texts'
words at most. The words that count are the ``most_features`` with the strongest two-proportion z-score among those
in ``least_texts`` or more texts. Every text is scored whole, in one pass without a shuffle.

Input: documents (doc_id, text) and labels (doc_id, toxic). Null and empty texts have no words; their score is that
of the intercept. Null labels or ids are not learnt from; an id labelled more than once counts once, as toxic if any
of its labels is. Without labels of both kinds the score is the share of toxic labels (0 without labels). Rows that
repeat an id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.session import stage

# Groups of identity terms; within a group each is swapped for the next.
IDENTITIES = (
    ("women", "men"),
    ("woman", "man"),
    ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("immigrants", "natives"),
    ("old", "young"),
)


@dataclass(frozen=True)
class Training:
    most_rows: int = 12_000
    most_words: int = 10_000_000
    most_features: int = 1024
    least_texts: int = 4
    least_z: float = 3.0
    ridge: float = 1e-4
    # Toxic texts are few; each counts so many times.
    toxic_weight: float = 8.0
    fairness: float = 1.0
    rounds: int = 300
    identities: tuple[tuple[str, ...], ...] = IDENTITIES


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, at, rows = present(texts, self.words)
        logit = self.intercept + np.bincount(row, self.weights[at], minlength=rows)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def hash_of(word: str) -> np.uint64:
    return W.word_hashes(W.split_words(pa.array([word]), W.PUNCTUATION))[0]


def present(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (row, index in ``known``) of the known words in each text, and the number of rows."""
    words = W.split_words(texts, W.PUNCTUATION)
    if not len(known) or not len(words.row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words.rows
    h = W.word_hashes(words)
    low = np.uint64((1 << 16) - 1)
    maybe = np.zeros(1 << 16, bool)
    maybe[known & low] = True
    hit = np.flatnonzero(maybe[h & low])
    at = np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)
    hit, at = hit[known[at] == h[hit]], at[known[at] == h[hit]]
    both = np.unique(words.row[hit] * len(known) + at)
    return both // len(known), both % len(known), words.rows


def lowered(text: str = "text") -> Column:
    return F.lower(F.col(text).cast("string"))


def sample(docs: DataFrame, labels: DataFrame, conf: Training) -> list[tuple[int, np.ndarray]]:
    """(label, sorted distinct word hashes) of the learnt rows, by id."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.count()
    share = min(1.0, conf.most_rows / max(rows, 1))
    taken = known.where(F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    taken = stage(taken.withColumnRenamed("doc_id", "_llm_id"), "labels")
    texts = docs.join(F.broadcast(taken), F.col("doc_id") == F.col("_llm_id")).select(
        "_llm_id", "toxic", lowered().alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                words = W.split_words(piece.column("text"), W.PUNCTUATION)
                h, first = W.word_hashes(words), words.first_of_row()
                sets = [np.unique(h[a:b]).view(np.int64) for a, b in zip(first, first[1:])]
                lists = pa.array(sets, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*piece.select(["_llm_id", "toxic"]).columns, lists], ["id", "toxic", "words"])

    rows = stage(texts.mapInArrow(run, "id long, toxic int, words array<long>"), "words")
    # Ids and sizes first, a row for each sampled label; then only the texts that stay below the bound on words.
    sizes = rows.groupBy("id").agg(F.sum(F.size("words")).alias("n")).orderBy("id").toArrow()
    within = np.cumsum(sizes["n"].to_numpy()) <= conf.most_words
    last = int(sizes["id"].to_numpy()[within].max()) if within.any() else None
    found = rows.where(F.col("id") <= last if last is not None else F.lit(False)).toArrow()
    order = np.argsort(found["id"].to_numpy(), kind="stable")
    lists, out = found["words"].combine_chunks(), []
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    toxic = found["toxic"].to_numpy()
    for i in order:
        out.append((int(toxic[i]), values[offsets[i] : offsets[i + 1]].view(np.uint64)))
    return out


def _chosen(rows: list[tuple[int, np.ndarray]], conf: Training) -> np.ndarray:
    """The word hashes that tell the labels apart best, sorted."""
    y = np.array([t for t, _ in rows])
    words, at = np.unique(np.concatenate([w for _, w in rows]), return_inverse=True)
    mine = np.repeat(y, [len(w) for _, w in rows])
    n, toxic = np.bincount(at, minlength=len(words)), np.bincount(at, mine, minlength=len(words))
    positives, negatives = y.sum(), len(y) - y.sum()
    p = n / len(y)
    spread = np.sqrt(np.maximum(p * (1 - p) * (1 / positives + 1 / negatives), 1e-12))
    z = np.abs(toxic / positives - (n - toxic) / negatives) / spread
    z[(n < conf.least_texts) | (z < conf.least_z)] = -1
    keep = np.lexsort((words, -z))[: conf.most_features]
    return np.sort(words[keep[z[keep] >= 0]])


def _swaps(conf: Training) -> dict[int, int]:
    return {
        int(hash_of(a)): int(hash_of(b)) for group in conf.identities for a, b in zip(group, [*group[1:], group[0]])
    }


def fit(rows: list[tuple[int, np.ndarray]], conf: Training = Training()) -> Model:
    """Fit to (label, distinct word hashes) by accelerated gradient descent; the result depends on the rows only."""
    y = np.array([t for t, _ in rows], float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(share, 1e-18) / max(1 - share, 1e-18))))
    swaps = _swaps(conf)
    terms = np.array(sorted({*swaps, *swaps.values()}), np.uint64)
    known = np.unique(np.concatenate([_chosen(rows, conf), terms]))
    index = {int(h): i for i, h in enumerate(known)}

    def columns(words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        return at[known[at] == words]

    cols = [columns(w) for _, w in rows]
    row = np.repeat(np.arange(len(rows)), [len(c) for c in cols])
    col = np.concatenate(cols)
    # Differences between a text with identity terms and its counterfactual: one row each, +1 and -1.
    drow, dcol, dval, pairs = [], [], [], 0
    for c in cols:
        mine = [int(known[i]) for i in c if int(known[i]) in swaps]
        if mine:
            before, after = {index[m] for m in mine}, {index[swaps[m]] for m in mine}
            for j in before ^ after:
                drow.append(pairs), dcol.append(j), dval.append(1.0 if j in before else -1.0)
            pairs += 1
    drow, dcol, dval = np.array(drow, int), np.array(dcol, int), np.array(dval, float)

    cost = np.where(y > 0, conf.toxic_weight, 1.0)
    cost /= cost.sum()

    def slope(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], minlength=len(y)), -40, 40)))
        miss = (p - y) * cost
        g = np.bincount(col, miss[row], minlength=len(w)) + conf.ridge * w
        if pairs:
            gap = np.bincount(drow, w[dcol] * dval, minlength=pairs)
            g = g + 2 * conf.fairness * np.bincount(dcol, gap[drow] * dval, minlength=len(w)) / pairs
        return g, float(miss.sum())

    # Diagonal scaling: a step is at most the inverse of a bound of the curvature along each word.
    width = np.bincount(row, minlength=len(y)).max() + 1
    bound = np.bincount(col, cost[row], minlength=len(known)) / 4
    scale = np.sqrt(width) * np.maximum(bound, 1 / len(y)) + conf.ridge
    if pairs:
        scale = scale + 8 * conf.fairness * np.bincount(dcol, minlength=len(known)) / pairs
    w, b = np.zeros(len(known)), float(np.log(cost[y > 0].sum() / cost[y == 0].sum()))
    ahead, b_ahead = w, b
    for k in range(conf.rounds):
        g, gb = slope(ahead, b_ahead)
        w_new, b_new = ahead - g / scale, b_ahead - gb
        push = k / (k + 3)
        if np.dot(g, w_new - w) + gb * (b_new - b) > 0:
            push = 0.0
        ahead, b_ahead = w_new + push * (w_new - w), b_new + push * (b_new - b)
        w, b = w_new, b_new
    return Model(known, w, b)


def learn(docs: DataFrame, labels: DataFrame, conf: Training = Training()) -> Model:
    return fit(sample(docs, labels, conf), conf)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(model.scores(piece.column("text")))], ["doc_id", "score"]
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered().alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents, with all columns, that score below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "_llm_text"):
                good = pa.array(model.scores(piece.column("_llm_text")) < threshold)
                yield piece.select(names).filter(good)

    names = docs.columns
    return docs.withColumn("_llm_text", lowered()).mapInArrow(run, docs.schema)


def learnable(df: DataFrame) -> DataFrame:
    """Rows that labels may be learnt from; the rest is held out."""
    return df.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
