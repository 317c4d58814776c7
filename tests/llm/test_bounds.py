"""Bounds of what learning takes, and columns that clash."""

import random

from skyledger.llm import components, secrets, toxicity


def test_words_of_the_sample_are_bounded_before_they_are_collected(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(100))) for i in range(40)] + [(3, "again here")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    sizes = lambda most: [len(words) for _, words in toxicity.sample(docs, labels, toxicity.Training(most_words=most))]
    assert len(sizes(10**6)) == 41 and sum(sizes(10**6)) == 4002
    assert len(sizes(950)) == 10 and sum(sizes(950)) == 902
    assert sizes(50) == []


def test_masking_keeps_a_column_of_the_same_name(spark):
    docs = spark.createDataFrame([(1, "password = hunter2hunter2", "own", 3), (2, None, None, 4)], "doc_id long, text string, secret_spans string, n int")
    rows = secrets.masked(docs).orderBy("doc_id").collect()
    assert [(r.secret_spans, r.n) for r in rows] == [("own", 3), (None, 4)]
    assert rows[0].asDict().keys() == dict.fromkeys(docs.columns).keys() and "[secret]" in rows[0].text


def test_components_of_stars_chains_and_loops(spark):
    rng = random.Random(4)
    links = [(0, i) for i in range(1, 60)] + [(100 + i, 200) for i in range(30)] + [(rng.randint(300, 420), rng.randint(300, 420)) for _ in range(70)]
    links += [(1000 + i, 1001 + i) for i in range(70)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component_id for r in found} == {x: find(x) for x in root if x not in alone}
    assert len(found) == len(root) - len(alone)
