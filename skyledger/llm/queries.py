"""One query for each operator, over its whole table; with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    alignment,
    decontamination,
    html_text,
    jaccard_join,
    language_id,
    mixing,
    packing,
    secrets,
    spelling,
    substrings,
    token_rollup,
    top_k,
    toxicity,
)
from skyledger.llm.tables import table
from skyledger.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def held_out(parts: int, part: int):
    """Whether a document is kept from learning, by its id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == part


@register
def op1_source_mix(spark, sf):
    return mixing.mixed(table(spark, sf, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", "position", "positions"
    )


@register
def op2_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return top_k.top_k(vectors.where("vec_id % 100 = 0"), vectors)


ORACLES["op2_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@register
def op3_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language_id.learn(docs.where(~held_out(4, 2)).select("doc_id", "text", "lang"))
    found = language_id.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "accepted")


@register
def op4_secret_scan(spark, sf):
    found = secrets.scanned(table(spark, sf, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(spans).alias("spans"),
        count(3).alias("n_random"),
    )


@register
def op5_token_rollup(spark, sf):
    """Documents enter with an estimate of a token per four characters; a second batch revises it to the exact
    counts of both tokenizers, and the first batch is sent once more."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "rollup"))
    bytes_50k = token_rollup.BytePairs("byte-bpe-50k-1")
    estimate = docs.select(
        F.lit("insert").alias("change"),
        "doc_id",
        "source",
        "lang",
        F.lit(bytes_50k.version).alias("tokenizer"),
        F.floor(F.coalesce(F.length("text"), F.lit(0)) / 4).cast("long").alias("tokens"),
    )
    rollup.commit("estimate", estimate)
    rollup.commit("exact", token_rollup.counted(docs, (bytes_50k,)).withColumn("change", F.lit("revise")))
    rollup.commit("estimate", estimate)
    return rollup.totals()


@register
def op6_substring_dedup(spark, sf):
    return substrings.digests(table(spark, sf, "documents"))


# Words of every text, null texts none.
WORDS_SQL = "list_filter(string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

ORACLES["op6_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, {WORDS_SQL.format(text="text")} AS words FROM documents),
windows AS (
  SELECT doc_id, place, array_to_string(words[place : place + 49], ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS place FROM w WHERE len(words) >= 50)
), least AS (SELECT body, min(doc_id) AS first FROM windows GROUP BY body),
hits AS (SELECT doc_id, place FROM windows JOIN least USING (body) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS place FROM hits),
lost AS (SELECT doc_id, list(place) AS lost FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(words) AS n_words, coalesce(len(lost), 0) AS n_removed,
    CASE WHEN lost IS NULL THEN words
         ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda p: NOT list_contains(lost, p[2])), lambda p: p[1]) END AS words
  FROM w LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""


@register
def op7_benchmark_overlap(spark, sf):
    return decontamination.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register
def op8_main_text(spark, sf):
    return html_text.extracted(table(spark, sf, "pages"))


@register
def op9_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, toxicity.learnable(table(spark, sf, "labels")))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@register
def op10_ngram_jaccard(spark, sf):
    return jaccard_join.joined(table(spark, sf, "documents"), jaccard_join.Similarity(3, 90, 100))


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; it is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


ORACLES["op10_ngram_jaccard"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS_SQL.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i : i + 2], ' ')) END) AS shingle FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * m >= 90 * (a.n + b.n - m)),
ends AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (SELECT x, y FROM ends UNION SELECT r.x, e.y FROM reached r JOIN ends e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(min(r.y), w.doc_id), w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reached r ON r.x = w.doc_id GROUP BY w.doc_id, n.n
"""


@register
def op11_packing(spark, sf):
    return packing.packed(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@register
def op12_spelling_variants(spark, sf):
    """One letter is deleted from one in 199 of the documents' distinct words, as misspellings."""
    runs = spelling.runs(table(spark, sf, "documents"))
    mark = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    place = F.pmod(F.col("mark"), F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    spelt = runs.withColumn("mark", mark).select(F.when(F.col("mark") % 199 == 0, less).otherwise(F.col("run")).alias("word"))
    counts = spelt.where(F.length("word") >= 6).groupBy("word").agg(F.count("*").alias("n")).where("n >= 5")
    return spelling.grouped(counts)


@register
def op13_token_alignment(spark, sf):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return alignment.scored(table(spark, sf, "documents"), *paths, digest=True).withColumnRenamed("groups", "groups_sha256")
