"""Kneser-Ney models against a plain computation over all n-grams."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyledger.llm import language_id

TEXTS = {"x": ["banana band ban an and", "a nab", "bandana banana"], "y": ["cab dab dabc abc", "bad cad abcd dcba", "bd"]}


def brute(texts, order):
    """P(last character | the others) of interpolated Kneser-Ney, as a function of a string."""
    tables, now = {}, Counter()
    for text in texts:
        padded = f" {text} "
        now.update(padded[i : i + order] for i in range(len(padded) - order + 1))
    letters = None
    for size in range(order, 0, -1):
        once, twice = (sum(n == k for n in now.values()) for k in (1, 2))
        discount = (once + 0.5) / (once + 2 * twice + 1)
        total, kinds = Counter(), Counter()
        for gram, n in now.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        tables[size] = (dict(now), discount, total, kinds)
        letters = set(now)
        before = defaultdict(set)
        for gram in now:
            before[gram[1:]].add(gram[0])
        now = Counter({gram: len(some) for gram, some in before.items()})
    return tables, letters


def probability(tables, letters, text):
    p = 1 / letters
    for size in range(1, len(text) + 1):
        counts, discount, total, kinds = tables[size]
        gram, context = text[-size:], text[-size:-1]
        if total[context]:
            p = max(counts.get(gram, 0) - discount, 0) / total[context] * (gram in counts) + discount * kinds[context] / total[context] * p
    return p


@pytest.mark.parametrize("order", [4, 2])
def test_models_are_those_of_a_plain_computation(spark, order):
    rows = [(100 * k + i, text, lang) for k, (lang, texts) in enumerate(TEXTS.items()) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.learn(docs, language_id.Setting(order=order, calibration=1_000_003))
    found = {lang: brute(texts, order) for lang, texts in TEXTS.items()}
    letters = len(set().union(*(letters for _, letters in found.values()))) + 1
    assert (model.languages, model.letters) == (["x", "y"], letters)
    for text in ("bana", "band", " ban", "abcd", "zzzz", "d ba", "xaba", "cab "):
        text = text[-order:]
        cost = model.costs(np.array([[ord(c) for c in text]], np.uint32))[0]
        wanted = [-math.log(probability(found[lang][0], letters, text)) for lang in model.languages]
        assert cost.tolist() == pytest.approx(wanted)
    # No n-gram is lost: as many hashes as there are n-grams.
    for k, lang in enumerate(model.languages):
        for size in range(1, order + 1):
            assert len(model.grams[k][size - 1][0]) == len(found[lang][0][size][0])
