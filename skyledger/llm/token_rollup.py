"""Token counts as rollups that are maintained by deltas.

Changes arrive in named batches: inserts and revised counts of documents (doc_id, source, lang, tokenizer, tokens)
and deletes (doc_id, tokenizer). A batch is turned into signed rows against what earlier batches left: the old counts
of a document leave, the new ones enter, also when its source or language has changed. Totals by source, language and
tokenizer version are sums of all signed rows, so they never need the texts again.

Three tables lie below one folder, each with a folder per batch: ``ledger`` (signed rows by document), ``deltas``
(their sums by source, language and tokenizer) and ``commits``. A batch counts from the moment its commit is written,
which is the last step; a batch that failed half-way is written over when it is tried again, and one that is
committed changes nothing when it is sent again. Batches are committed one after the other by one writer.

An insert of a known document revises it. A delete of an unknown one does nothing. Rows of one batch with the same
id and tokenizer are added up (a delete among them is applied first). Documents without an id count in the totals but
can't be revised. Null source and language are groups of their own; null counts are 0. Empty batches are committed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import words as W

GROUP = ["source", "lang", "tokenizer"]
LEDGER = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long, batch string"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, batch string"
COMMITS = "batch string"
# Fixed value: how this vocabulary's publishers split text before its merges.
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space outside of 0x09-0x0D and 0x20, which may touch a split at those.
OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


class Rollup:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._write(spark.createDataFrame([], COMMITS), "commits", "start")

    def _write(self, df: DataFrame, kind: str, batch: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{kind}/of={batch}")

    def _read(self, kind: str, schema: str) -> DataFrame:
        """The rows of committed batches."""
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{kind}/of={b}" for b in batches])

    def committed(self) -> list[str]:
        rows = self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits").where("batch IS NOT NULL").collect()
        return sorted(r.batch for r in rows)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply changes (change: insert, revise or delete; doc_id, source, lang, tokenizer, tokens) once.

        False if the batch has been committed before.
        """
        if not re.fullmatch(r"[\w-]+", batch) or batch == "start":
            raise ValueError(f"a batch's name is made of letters, digits, _ and -: {batch!r}")
        if batch in self.committed():
            return False
        columns = ["doc_id", *GROUP]
        enter = changes.where("change IN ('insert', 'revise')").select(
            *columns, F.lit(1).cast("long").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens")
        )
        touched = changes.where("doc_id IS NOT NULL").select("doc_id", "tokenizer").distinct()
        leave = self._read("ledger", LEDGER).join(touched, ["doc_id", "tokenizer"], "left_semi").select(
            *columns, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")
        )
        signed = enter.unionByName(leave).groupBy(*columns).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        signed = signed.where("docs <> 0 OR tokens <> 0").withColumn("batch", F.lit(batch))
        self._write(signed, "ledger", batch)
        rows = self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger/of={batch}")
        sums = rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        self._write(sums.withColumn("batch", F.lit(batch)), "deltas", batch)
        self._write(self.spark.createDataFrame([(batch,)], COMMITS), "commits", batch)
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) of all committed batches."""
        sums = self._read("deltas", DELTAS).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")


@dataclass(frozen=True)
class BytePairs:
    """A byte-level vocabulary: a file of ranks and the pattern that splits text; read once, by the driver."""

    version: str
    path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = BYTE_BPE_PATTERN

    def ranks(self) -> dict[bytes, int]:
        with open(self.path, "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}


def unit_counts(texts: pa.Array, count) -> np.ndarray:
    """Tokens of each row, as a sum over units: a word with the white space before it, or white space at the end.

    The pattern never joins what is left of white space with it, so a text's tokens are those of its units. Equal units
    are counted once for the piece. Texts with other white space than 0x09-0x0D and 0x20 are counted whole.
    """
    data, offsets = W.text_bytes(texts)
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    space = W.SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = np.append(space, False)
    begins[1:-1] &= ~space[:-1]
    begins |= first
    start = np.flatnonzero(begins[:-1])
    end = np.append(start[1:], len(data))
    keys, _ = pd.factorize(W.range_hashes(data, start, end))
    some = np.zeros(keys.max() + 1, np.int64)
    some[keys] = np.arange(len(keys))
    raw = data.tobytes()
    n = np.array([count(raw[start[i] : end[i]].decode()) for i in some], np.int64)
    row = np.searchsorted(offsets, start, side="right") - 1
    total = np.bincount(row, n[keys], minlength=len(offsets) - 1).astype(np.int64)
    if OTHER_SPACE.search(raw.decode()):
        for i, text in enumerate(texts.to_pylist()):
            if text and OTHER_SPACE.search(text):
                total[i] = count(text)
    return total


def counted(docs: DataFrame, vocabularies: tuple[BytePairs, ...], words: str = "words-1") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens) of every document: words, and each vocabulary's tokens."""
    known = [(v.version, v.pattern, v.ranks()) for v in vocabularies]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        counters = []
        for version, pattern, ranks in known:
            coder = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            counters.append((version, lambda text, coder=coder: len(coder.encode_ordinary(text))))
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                texts = piece.column("text").fill_null("")
                found = [(words, W.split_words(texts).per_row())]
                found += [(version, unit_counts(texts, count)) for version, count in counters]
                for version, n in found:
                    yield pa.RecordBatch.from_arrays(
                        [*piece.select(["doc_id", "source", "lang"]).columns, pa.array([version] * len(n), pa.string()), pa.array(n.astype(np.int64))],
                        ["doc_id", "source", "lang", "tokenizer", "tokens"],
                    )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")],
    )
    return narrow.mapInArrow(run, "doc_id long, source string, lang string, tokenizer string, tokens long")
