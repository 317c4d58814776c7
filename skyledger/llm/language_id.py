"""Language identification with interpolated Kneser-Ney character models.

A text is lower-cased, all but letters become one space, and a space is put at both ends. Each language has a model
of ``order`` characters: counts of whole n-grams at the top, continuation counts (how many different characters go
before) below, one absolute discount per order from the numbers of n-grams seen once and twice, down to the uniform
distribution. Counts come from all learnt texts, as sums of what each piece of text has; lower orders are derived
from the distinct n-grams above, so text is gone through once.

A model is stored per order as two sorted arrays of hashes: n-grams with their discounted probability, contexts with
their back-off weight. Hashes have 64 bits, so a model holds every n-gram that was seen and grows with the input.
The language with the lowest cross-entropy per character wins. A text shorter than ``order`` is judged by the lower
orders, each character after the first given those before it.

Rejection: a first model counts all learnt documents but one in ``calibration``. On those, the gap in cross-entropy
between the best two languages, times the root of the length, is fitted to whether the best is right (a logistic
curve, from counts in fixed bins). The curve's value is the score; below ``reject`` the answer is marked as not
accepted. The model that is returned counts all learnt documents. Documents of a language that the first model lacks
don't take part in the fit. Both models come from one pass over the texts and one table for each order, written
before the next order reads it; what goes to the driver are numbers: hashes, values and indexes of languages.

Null texts and texts without letters are ``und`` with score 0. Null languages or ids are not learnt from. Without a
learnt language all texts are ``und``; with only one the score of texts with letters is the curve's at a gap of 0.
Rows that repeat an id are learnt and judged each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.session import stage

PIECE_CHARS = 1 << 20
BINS, WIDEST = 400, 40.0


@dataclass(frozen=True)
class Setting:
    order: int = 4
    hash_bits: int = 64
    calibration: int = 16  # one in so many learnt documents calibrates
    reject: float = 0.5


def letters_only(text: Column) -> Column:
    """' a text ' with one space for each run without letters; null if there is no letter."""
    kept = F.trim(F.regexp_replace(F.lower(text.cast("string")), r"[^\p{L}]+", " "))
    return F.when(kept != "", F.concat(F.lit(" "), kept, F.lit(" ")))


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place from order - 1 on."""
    out = np.zeros(max(len(codes) - order + 1, 0), np.uint64)
    for j in range(order):
        out = (out + codes[j : len(codes) - order + 1 + j].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return W.mix(out)


def pieces(texts: list[str | None], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each n-gram, characters) of pieces of at most about PIECE_CHARS characters.

    A long text goes in parts that overlap by order - 1 characters; n-grams across texts have row -1.
    """
    parts, rows, size = [], [], 0

    def out():
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        n = np.array([len(p) for p in parts])
        row = np.repeat(np.array(rows), n)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(n) - n, n)
        left = np.repeat(n, n) - place
        return np.where(left >= order, row, -1)[: max(len(codes) - order + 1, 0)], codes

    for i, text in enumerate(texts):
        for a in range(0, len(text or ""), PIECE_CHARS):
            part = text[a : a + PIECE_CHARS + order - 1]
            parts.append(part), rows.append(i)
            size += len(part)
            if size >= PIECE_CHARS:
                yield out()
                parts, rows, size = [], [], 0
    if parts:
        yield out()


def gram_counts(docs: DataFrame, conf: Setting) -> DataFrame:
    """(lang, gram, n, n_first): n-grams of the top order over all rows of (text, lang, first), and over the first ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, langs = pd.factorize(np.array(batch.column("lang").to_pylist(), dtype=object))[::-1]
            first = batch.column("first").to_numpy(zero_copy_only=False)
            for row, codes in pieces(batch.column("text").to_pylist(), conf.order):
                at = np.flatnonzero(row >= 0)
                keys, distinct = pd.factorize(_grams(codes, conf.order)[at])
                both, place, n = np.unique(keys * len(names) + langs[row[at]], return_inverse=True, return_counts=True)
                n_first = np.bincount(place, first[row[at]], minlength=len(both)).astype(np.int64)
                some = np.zeros(len(distinct), np.int64)
                some[keys] = at
                text = [codes[a : a + conf.order].tobytes().decode("utf-32-le") for a in some]
                gram, lang = both // len(names), both % len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[i] for i in lang], pa.string()),
                        pa.array([text[g] for g in gram], pa.string()),
                        pa.array(n),
                        pa.array(n_first),
                    ],
                    ["lang", "gram", "n", "n_first"],
                )

    text = letters_only(F.col("text"))
    rows = docs.select(text.alias("text"), F.col("lang").cast("string").alias("lang"), "first").where("text IS NOT NULL")
    found = rows.mapInArrow(run, "lang string, gram string, n long, n_first long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("n_first").alias("n_first"))


FINAL, FIRST = 0, 1


def levels(grams: DataFrame, order: int) -> list[DataFrame]:
    """(model, lang, size, is_context, gram, value) by size: discounted probabilities of n-grams, weights of contexts.

    Each order's counts and values are written before the next order reads them.
    """
    tagged = [F.struct(F.lit(FINAL).alias("model"), F.col("n")), F.struct(F.lit(FIRST).alias("model"), F.col("n_first").alias("n"))]
    now = grams.select("lang", "gram", F.inline(F.array(*tagged))).where("n > 0")
    found = []
    for size in range(order, 0, -1):
        stats = now.groupBy("model", "lang").agg(
            F.count(F.when(F.col("n") == 1, 1)).alias("once"), F.count(F.when(F.col("n") == 2, 1)).alias("twice")
        )
        discount = (F.col("once") + 0.5) / (F.col("once") + 2 * F.col("twice") + 1)
        stats = stats.select("model", "lang", discount.alias("d"))
        context = F.substring("gram", 1, size - 1).alias("context")
        contexts = now.groupBy("model", "lang", context).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        weighed = stage(contexts.join(stats, ["model", "lang"]), "contexts")
        p = now.withColumn("context", context).join(weighed, ["model", "lang", "context"])
        value = (F.col("n") - F.col("d")) / F.col("total")
        back = F.col("d") * F.col("kinds") / F.col("total")
        one = lambda is_context, gram, v: ("model", "lang", F.lit(is_context).alias("is_context"), gram, v.alias("value"))
        both = p.select(*one(False, "gram", value)).union(weighed.select(*one(True, F.col("context").alias("gram"), back)))
        found.append(stage(both, "level").withColumn("size", F.lit(size)))
        # How many different characters go before each shorter n-gram.
        if size > 1:
            fewer = now.groupBy("model", "lang", F.substring("gram", 2, size - 1).alias("gram")).agg(F.count("*").alias("n"))
            now = stage(fewer, "grams")
    return found


@dataclass
class Model:
    languages: list[str]
    order: int
    bits: int
    # By language and size: sorted hashes and values of n-grams, and of contexts.
    grams: list[list[tuple[np.ndarray, np.ndarray]]]
    contexts: list[list[tuple[np.ndarray, np.ndarray]]]
    letters: int
    curve: tuple[float, float] = (1.0, 0.0)
    reject: float = 0.5

    @staticmethod
    def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
        known, values = table
        if not len(known):
            return np.full(len(keys), missing)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[at], missing)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """-ln probability of the last of each row's characters given the others: (n-grams, languages)."""
        n, width = codes.shape
        out = np.empty((n, len(self.languages)))
        keys = [_hash_rows(codes[:, width - s :], self.bits) for s in range(1, width + 1)]
        before = [_hash_rows(codes[:, width - s : -1], self.bits) for s in range(1, width + 1)]
        for k in range(len(self.languages)):
            p = np.full(n, 1.0 / self.letters)
            for s in range(width):
                # A context not seen passes everything on.
                back = self._look(self.contexts[k][s], before[s], 1.0)
                p = self._look(self.grams[k][s], keys[s], 0.0) + back * p
            out[:, k] = -np.log(p)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character by (text, language), and the number of characters."""
        total, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for row, codes in pieces(texts, self.order):
            at = np.flatnonzero(row >= 0)
            if not len(at):
                continue
            keys, _ = pd.factorize(_grams(codes, self.order)[at])
            some = np.zeros(keys.max() + 1, np.int64)
            some[keys] = at
            cost = self.costs(np.stack([codes[some + j] for j in range(self.order)], axis=1))
            begin = np.flatnonzero(np.concatenate([[True], np.diff(row[at]) != 0]))
            rows = row[at][begin]
            for k in range(len(self.languages)):
                total[rows, k] += np.add.reduceat(cost[keys, k], begin)
            count[rows] += np.diff(np.append(begin, len(at)))
        for size in range(2, self.order):
            rows = [i for i, t in enumerate(texts) if t and len(t) == size]
            if rows:
                codes = np.frombuffer("".join(texts[i] for i in rows).encode("utf-32-le"), np.uint32).reshape(-1, size)
                total[rows] = sum(self.costs(codes[:, :width]) for width in range(2, size + 1))
                count[rows] = size - 1
        return total / np.maximum(count, 1)[:, None], count

    def judged(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language (-1: no letters), the gap to the next times the root of the length, characters."""
        cost, count = self.entropies(texts)
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), count
        best = np.argmin(cost, axis=1)
        two = np.sort(cost, axis=1)
        gap = (two[:, 1] - two[:, 0]) * np.sqrt(count) if len(self.languages) > 1 else np.zeros(len(texts))
        return np.where([bool(t) for t in texts], best, -1), gap, count

    def score(self, gap: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * gap + self.curve[1], -40, 40)))


def _hash_rows(codes: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        out = (out + codes[:, j].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return W.mix(out) >> np.uint64(64 - bits)


def _numbers(table: DataFrame, languages: list[str], bits: int) -> pa.Table:
    """(model, lang, is_context, key, value) of one size, all of them numbers."""
    place = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("gram").to_pylist()
            n = len(texts[0]) if texts else 0
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), n)
            lang = [place[name] for name in batch.column("lang").to_pylist()]
            key = _hash_rows(codes, bits).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("model"), pa.array(lang, pa.int32()), batch.column("is_context"), pa.array(key), batch.column("value")],
                ["model", "lang", "is_context", "key", "value"],
            )

    rows = table.select("model", "lang", "is_context", "gram", "value")
    # N-grams and contexts differ in length, so each batch is of one kind.
    kinds = [rows.where("NOT is_context"), rows.where("is_context")]
    schema = "model int, lang int, is_context boolean, key long, value double"
    return pa.concat_tables([kind.mapInArrow(run, schema).toArrow() for kind in kinds])


def learn(docs: DataFrame, conf: Setting = Setting()) -> Model:
    """A model of every non-null language of (doc_id, text, lang)."""
    learnt = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL")
    kept = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(conf.calibration)) == 0
    grams = stage(gram_counts(learnt.withColumn("first", (~kept).cast("int")), conf), "grams")
    model, first = _fitted(grams, conf)
    if len(first.languages) > 1:
        model.curve = _calibrated(learnt.where(kept & F.col("lang").cast("string").isin(first.languages)), first)
    return model


def _fitted(grams: DataFrame, conf: Setting) -> tuple[Model, Model]:
    """The final and the first model of (lang, gram, n, n_first), without a curve."""
    seen = grams.groupBy("lang").agg(F.sum("n_first").alias("first")).orderBy("lang").collect()
    languages = [r.lang for r in seen]
    empty = lambda: [[(np.zeros(0, np.uint64), np.zeros(0))] * conf.order for _ in languages]
    grams_of, contexts_of = [empty(), empty()], [empty(), empty()]
    letters = [1, 1]
    for table, size in zip(levels(grams, conf.order), range(conf.order, 0, -1)):
        found = _numbers(table, languages, conf.hash_bits)
        model, lang, is_context, key, value = (c.to_numpy() for c in found.columns)
        key = key.view(np.uint64)
        order = np.lexsort((key, is_context, lang, model))
        group = ((model * len(languages) + lang) * 2 + is_context)[order]
        cuts = np.searchsorted(group, np.arange(4 * len(languages) + 1))
        for m in (FINAL, FIRST):
            for k in range(len(languages)):
                for kind, tables in enumerate((grams_of, contexts_of)):
                    at = order[slice(*cuts[2 * (m * len(languages) + k) + kind :][:2])]
                    tables[m][k][size - 1] = key[at], value[at]
            if size == 1:
                letters[m] = max(len(np.unique(key[(model == m) & ~is_context])), 1) + 1
    first = [k for k, r in enumerate(seen) if r.first]
    return tuple(
        Model([languages[k] for k in of], conf.order, conf.hash_bits, [grams_of[m][k] for k in of], [contexts_of[m][k] for k in of],
              letters[m], reject=conf.reject)
        for m, of in ((FINAL, range(len(languages))), (FIRST, first))
    )


def _calibrated(docs: DataFrame, model: Model) -> tuple[float, float]:
    """Slope and offset of the logistic curve of being right over the gap, from counts in bins of the gap."""
    right = F.col("lang_pred") == F.col("lang")
    bins = F.least(F.floor(F.col("gap") * (BINS / WIDEST)), F.lit(BINS - 1)).cast("int").alias("bin")
    rows = identified(docs, model, "lang").where("lang_pred <> 'und'").groupBy(bins).agg(
        F.count("*").alias("n"), F.count(F.when(right, 1)).alias("right")
    )
    found = rows.collect()
    if not found:
        return 1.0, 0.0
    x = np.array([(r.bin + 0.5) * WIDEST / BINS for r in found])
    n, good = np.array([r.n for r in found], float), np.array([r.right for r in found], float)
    # Platt's targets keep the curve finite when all are right.
    high, low = (good.sum() + 1) / (good.sum() + 2), 1 / ((n - good).sum() + 2)
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        miss, w = n * p - good * high - (n - good) * low, n * p * (1 - p) + 1e-9
        hess = np.array([[np.sum(w * x * x) + 1e-3, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        step = np.linalg.solve(hess, [np.sum(miss * x) + 1e-3 * (a - 0.1), np.sum(miss) + 1e-3 * b])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(max(a, 0.0)), float(b)


def identified(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """(doc_id, kept columns, lang_pred, score, gap, accepted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, gap, _ = model.judged(batch.column("text").to_pylist())
            names = np.array([*model.languages, "und"], dtype=object)[best]
            score = np.where(best >= 0, model.score(gap), 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["doc_id", *keep]).columns,
                    pa.array(names, pa.string()),
                    *map(pa.array, (score, gap, (best >= 0) & (score >= model.reject))),
                ],
                ["doc_id", *keep, "lang_pred", "score", "gap", "accepted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in keep],
        letters_only(F.col("text")).alias("text"),
    )
    kept = "".join(f"{c} string, " for c in keep)
    return rows.mapInArrow(run, f"doc_id long, {kept}lang_pred string, score double, gap double, accepted boolean")
