"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents are linked if the Jaccard similarity of their sets of word shingles reaches a threshold t. With one
order over all shingles, a set of n shingles has as its l-prefix the first n - ceil(t n) + l of them; two similar
sets share at least min(l, l') shingles of their prefixes. The order puts rare shingles first. A document whose
prefix has shingles that many documents share gets a longer prefix and must share more of it (l from 1 to 4, by the
summed lengths of the lists its prefix would meet), which keeps frequent passages from making candidates.

Steps:

1. Copies: documents with the same shingle set (size and 128 bits of sums over its hashes) form a class; one of
   each class, the smallest id, takes part in the join.
2. Frequencies: only shingles whose hash lies in a fixed part of the hash range (a little more than a prefix
   needs) are counted and listed, plus the smallest ones of a set where that part has too few for its prefix. The
   order is: shingles of that part by frequency, then the others by hash. It is the same for all documents.
3. Stars: in each list one member, another for each list, is the hub; the others are checked against it. A group
   of many near copies becomes connected here by as many checks as its lists are long, not by all pairs.
4. Pairs: members of one list that are in different components are checked if they share the number of prefix
   shingles asked for. A set with few meetings in its lists (by its size) is met there, so the meetings of all these
   sets are in proportion to their shingles. The other, crowded sets are listed again, now with
   all their shingles, and meet each other by these. Shingles that only one component has come first in a new order,
   the others by the pairs they would make. The places up to which two sets must meet follow from both sizes, so sets
   with enough shingles outside any other component meet nobody, however many share the rest. Nothing is capped, so
   no link between different components is lost.

Before a check, sizes and 256 parity bits of both sets give an upper bound of their similarity; pairs below the
threshold by that bound go no further.

Checks are exact, on the sets of both whole texts. Links inside a component that are not needed to connect it
are not looked for.

Input: columns doc_id (integer) and text; others are ignored. Words are runs other than space and 0x09-0x0D, A-Z
are lower-cased. Null or empty texts have no shingles and no links; a text with fewer words than a shingle has its
whole sequence as its one shingle. Rows with a null doc_id take no part in links and have a null component. Rows
that repeat a doc_id are linked like other documents and share the id. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.components import components
from skyledger.llm.tables import drop_ids, keep_ids, rows_per_batch
from skyledger.session import stage

# Summed list lengths from which a prefix grows by one more match, for l = 2, 3 and 4.
COSTS = (64, 1024, 16384)
MOST_MATCHES = len(COSTS) + 1
# The listed part of the hash range, as a multiple of 1 - t.
LISTED = 1.5
PARITIES = ("p0", "p1", "p2", "p3")
# A set is crowded if the sets it would meet in its lists are more than so many times its shingles.
CROWDED = 4
# Sizes that differ by less than this factor share a band, in which sets of other components meet.
BAND = 1.05
# Rows in a batch for the workers, which hold two whole texts of a pair.
BATCH = 500


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; linked if ``over`` * intersection >= ``at_least`` * union."""

    words: int = 5
    at_least: int = 80
    over: int = 100

    @property
    def threshold(self) -> Fraction:
        return Fraction(self.at_least, self.over)

    def needed(self, n: np.ndarray) -> np.ndarray:
        """Shingles that a set of n must share with any similar one: ceil(t n)."""
        return -(-n * self.at_least // self.over)

    @property
    def part(self) -> int:
        """Hashes below this (of 48 bits) are listed for every document."""
        return int(min(1.0, LISTED * float(1 - self.threshold)) * 2**48)


def _sums(row: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (0x632BE59BD9B4E019, 0xD1342543DE82EF95):
        sums = np.zeros(len(key) + 1, np.uint64)
        np.cumsum(W.mix(key ^ np.uint64(salt)), out=sums[1:])
        at = np.concatenate([[0], np.cumsum(n)])
        out.append(W.signed(sums[at[1:]] - sums[at[:-1]]))
    return tuple(out)


def _parities(row: np.ndarray, key: np.ndarray, rows: int) -> list[np.ndarray]:
    """Bit j of a row's 256 bits: whether an odd number of its shingles falls into bucket j."""
    word, bit = (key >> np.uint64(6)) & np.uint64(3), np.uint64(1) << (key & np.uint64(63))
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    out = []
    for w in range(4):
        bits = np.zeros(rows, np.uint64)
        if len(row):
            bits[row[begin]] = np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), begin)
        out.append(W.signed(bits))
    return out


def signatures(docs: DataFrame, like: Similarity) -> DataFrame:
    """(doc_id, n, s1, s2, p0..p3): size, sums and parities of each document's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                row, key, n = W.shingles(W.split_words(piece.column("text"), lower=True), like.words)
                found = [n, *_sums(row, key, n), *_parities(row, key, len(n))]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, found)], names)

    names = ["doc_id", "n", "s1", "s2", *PARITIES]
    return _narrow(docs).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def listings(docs: DataFrame, like: Similarity, whole: bool = False) -> DataFrame:
    """(s1, n, token, listed, rank): the shingles that may be in a prefix, of 48 bits each; s1 and n name the set.

    For a ``whole`` listing the listed part is the whole hash range. ``listed`` is the number of the document's
    shingles in the listed part; the first so many of its hashes, by ``rank``, are in it.
    """
    below = 2**48 if whole else like.part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                row, key, n = W.shingles(W.split_words(piece.column("text"), lower=True), like.words)
                s1, _ = _sums(row, key, n)
                key = (key >> np.uint64(16)).astype(np.int64)
                rank = np.arange(len(key)) - (np.cumsum(n) - n)[row]
                inside = key < below
                listed = np.bincount(row[inside], minlength=len(n))
                longest = np.minimum(n - like.needed(n) + MOST_MATCHES, n)
                take = inside | (rank < longest[row])
                row, key, rank = row[take], key[take], rank[take]
                found = [s1[row], n[row], key, listed[row], rank]
                yield pa.RecordBatch.from_arrays([*map(pa.array, found)], names)

    names = ["s1", "n", "token", "listed", "rank"]
    return _narrow(docs).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def prefixes(listed: DataFrame, like: Similarity) -> DataFrame:
    """(token, s1, n, matches): the shingles of each set's adaptive prefix that others list as well.

    A set's shingles of the listed part that no other has come first in the order and meet nobody: they only
    count as places.
    """
    frequent = stage(listed.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "frequent")
    inside = F.col("rank") < F.col("listed")
    whole = Window.partitionBy("s1", "n")
    order = whole.orderBy(F.when(inside, 0).otherwise(1), "df", "token")
    shortest, matches = _shortest(like), _matches(like)
    return (
        listed.join(frequent, "token")
        .withColumn("alone", F.col("listed") - F.sum(F.when(inside, 1).otherwise(0)).over(whole))
        .withColumn("nth", F.when(inside, F.col("alone") + F.row_number().over(order)).otherwise(F.col("rank") + 1))
        .withColumn("cost", F.sum(F.when(F.col("nth") <= shortest + 1, F.col("df"))).over(whole))
        .withColumn("matches", matches)
        .where(F.col("nth") <= shortest + F.col("matches"))
        .select("token", "s1", "n", "matches")
    )


def _shortest(like: Similarity):
    """Places of a set that a similar one may lack."""
    return F.col("n") - F.ceil(F.col("n") * like.at_least / like.over)


def _matches(like: Similarity):
    """The matches a prefix is made for, by its cost; never more than a similar set must share."""
    by_cost = sum((F.when(F.col("cost") >= c, 1).otherwise(0) for c in COSTS), F.lit(1))
    return F.least(by_cost, F.col("n") - _shortest(like))


def _may_be_alike(like: Similarity, x: str, y: str):
    """False only for sets that can't be similar, by their sizes and by the shingles that just one of them has.

    Buckets whose parities differ hold at least one such shingle each.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    apart = sum(F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in PARITIES)
    return (F.least(n, m) * like.over >= F.greatest(n, m) * like.at_least) & (
        apart * (like.over + like.at_least) <= (n + m) * (like.over - like.at_least)
    )


def stars(prefix: DataFrame, like: Similarity) -> DataFrame:
    """Pairs (a, b) of each list's hub with its other members; a list's hub is drawn by a hash of both."""
    hub = F.min_by(F.struct("doc_id", "n", *PARITIES), F.xxhash64("doc_id", "token"))
    hubs = prefix.groupBy("token").agg(hub.alias("hub"), F.count("*").alias("m")).where("m > 1")
    return (
        prefix.alias("x")
        .join(hubs.select("token", "hub.*").alias("y"), "token")
        .where("x.doc_id <> y.doc_id")
        .where(_may_be_alike(like, "x", "y"))
        .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
        .distinct()
    )


def met(prefix: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``prefix`` whose shingle another component lists as well.

    Added are ``part``, the component, ``common``, whether it is the one that lists the shingle most, and ``crowded``,
    of a set as a whole.
    """
    labels = labels.select(F.col("node").alias("doc_id"), "component_id")
    part = F.coalesce("component_id", "doc_id").alias("part")
    placed = prefix.join(labels, "doc_id", "left").select(*prefix.columns, part)
    held = placed.groupBy("token", "part").agg(F.count("*").alias("rows"))
    df, largest = F.sum("rows").alias("df"), F.max(F.struct("rows", "part")).alias("largest")
    mixed = held.groupBy("token").agg(df, largest, F.count("*").alias("parts")).where("parts > 1")
    common = F.col("part") == F.col("largest.part")
    meets = F.col("df") - F.when(common, F.col("largest.rows")).otherwise(0)
    meetings = F.sum(meets).over(Window.partitionBy("doc_id", "n"))
    return placed.join(mixed, "token").select(
        *placed.columns, common.alias("common"), (meetings > CROWDED * F.col("n")).alias("crowded")
    )


def pairs_met(placed: DataFrame, like: Similarity) -> DataFrame:
    """Pairs (a, b) of different components, crowded ones with others only, that share as many prefix shingles as asked.

    Members of the component that lists a shingle most don't meet each other.
    """
    no = F.lit(False)
    all_sets = placed.withColumn("with", F.explode(F.when(F.col("common"), F.array(no)).otherwise(F.array(no, F.lit(True)))))
    meet = (
        placed.where("NOT crowded")
        .withColumn("with", F.col("common"))
        .alias("x")
        .join(all_sets.alias("y"), ["token", "with"])
        .where("x.part <> y.part AND x.doc_id <> y.doc_id AND (y.crowded OR x.doc_id < y.doc_id)")
        .where(_may_be_alike(like, "x", "y"))
    )
    return _sharing_enough(meet)


def _sharing_enough(meet: DataFrame) -> DataFrame:
    """Pairs (a, b) of x and y that meet as often as asked."""
    return (
        meet.groupBy(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
        .agg(F.count("*").alias("met"), F.min(F.least("x.matches", "y.matches")).alias("asked"))
        .where("met >= asked")
        .select("a", "b")
    )


def _mixed(placed: DataFrame) -> DataFrame:
    """The shingles that more than one component has."""
    ends = placed.groupBy("token").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    return ends.where("least < most").select("token")


def prefixes_between(whole: DataFrame, like: Similarity) -> DataFrame:
    """The rows of ``whole`` in each set's adaptive prefix that another component lists as well.

    ``whole`` has all shingles of the sets as (token, s1, n, part) and more columns; ``matches``, ``after``, the
    shingles of the set behind this one, and ``common``, whether the set's component is the one that lists it most,
    are added. Shingles of one component only come first in the order and just count as places. The prefix is for
    similar sets of any size, its cost that of meeting larger ones.
    """
    shared = stage(whole.join(_mixed(whole), "token", "left_semi"), "shared")
    held = shared.groupBy("token", "part").agg(F.count("*").alias("rows"))
    df, own = F.sum("rows"), F.sum(F.col("rows") * F.col("rows"))
    largest = F.max(F.struct("rows", "part"))["part"].alias("largest")
    frequent = stage(held.groupBy("token").agg(df.alias("df"), (df * df - own).alias("meets"), largest), "frequent")
    one = Window.partitionBy("s1", "n")
    nth = F.col("n") - F.count("*").over(one) + F.row_number().over(one.orderBy("meets", "token"))
    early = _leaves_room(like, F.col("n"), F.col("n"), F.col("after") + 1)
    return (
        shared.join(frequent, "token")
        .withColumn("after", F.col("n") - nth)
        .withColumn("cost", F.coalesce(F.sum(F.when(early, F.col("df"))).over(one), F.lit(0)))
        .withColumn("matches", _matches(like))
        .where(F.col("n") - F.col("after") <= _shortest(like) + F.col("matches"))
        .select(*whole.columns, "matches", "after", (F.col("part") == F.col("largest")).alias("common"))
    )


def _leaves_room(like: Similarity, n, m, room):
    """Whether ``room`` common shingles are enough for similar sets of n and m."""
    return (n + m) * like.at_least <= room * (like.over + like.at_least)


def _band(size):
    return F.floor(F.log(size.cast("double")) / math.log(BAND))


def pairs_between(placed: DataFrame, like: Similarity) -> DataFrame:
    """Pairs (a, b) of different components that share as many prefix shingles as similar documents must.

    The last shared one asked for stands where both sets still have as many as two sets of their sizes must share.
    The smaller set of a pair thus meets by its first places only, those that suffice for two sets of its size; a
    place of the larger one suffices for smaller sets up to some size. They meet in bands of the smaller size. Members
    of the component that lists a shingle most don't meet each other.
    """
    no = F.lit(False)
    n, room = F.col("n"), F.col("after") + F.col("matches")
    least = F.ceil(n * like.at_least / like.over)
    most = F.least(n, F.floor(room * (like.over + like.at_least) / like.at_least) - n)
    early = placed.where(_leaves_room(like, n, n, room)).withColumn("band", _band(n))
    larger = (
        placed.where(most >= least)
        .withColumn("band", F.explode(F.sequence(_band(least), _band(most))))
        .withColumn("with", F.explode(F.when(F.col("common"), F.array(no)).otherwise(F.array(no, F.lit(True)))))
    )
    asked = F.least("x.matches", "y.matches")
    meet = (
        early.withColumn("with", F.col("common"))
        .alias("x")
        .join(larger.alias("y"), ["token", "band", "with"])
        .where("(x.n < y.n OR x.n = y.n AND x.doc_id < y.doc_id) AND x.part <> y.part")
        .where(_leaves_room(like, F.col("x.n"), F.col("y.n"), F.least("x.after", "y.after") + asked))
        .where(_may_be_alike(like, "x", "y"))
    )
    return _sharing_enough(meet)


def _overlaps(a: W.Words, b: W.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: shared shingles, shingles of a, shingles of b."""
    ra, ka, na = W.shingles(a, k)
    rb, kb, nb = W.shingles(b, k)
    row, key = np.concatenate([ra, rb]), np.concatenate([ka, kb])
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    same = (row[1:] == row[:-1]) & (key[1:] == key[:-1])
    return np.bincount(row[1:][same], minlength=len(na)), na, nb


def verified(pairs: DataFrame, docs: DataFrame, like: Similarity) -> DataFrame:
    """The pairs (a, b) whose documents are similar, by the sets of their whole texts."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = keep_ids(_narrow(docs), ends)
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (p for x in W.pieces(batch, "text_a") for p in W.pieces(x, "text_b")):
                both, na, nb = _overlaps(
                    W.split_words(piece.column("text_a"), lower=True),
                    W.split_words(piece.column("text_b"), lower=True),
                    like.words,
                )
                good = (both > 0) & (like.over * both >= like.at_least * (na + nb - both))
                yield piece.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _repeated(ids: DataFrame) -> DataFrame:
    """The ids that more than one row has; mostly none."""
    rows = ids.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"))
    return stage(rows.where("rows > 1").select("doc_id"), "repeated")


def joined(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id): the documents and the smallest doc_id each is linked with, by any path."""
    with rows_per_batch(docs.sparkSession, BATCH):
        return _joined(docs, like)


def _joined(docs: DataFrame, like: Similarity) -> DataFrame:
    sets = stage(signatures(docs, like), "sets")
    real = sets.where("n > 0 AND doc_id IS NOT NULL")
    marks = [F.min(p).alias(p) for p in PARITIES]
    classes = stage(real.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("first"), *marks), "classes")
    members = real.select("doc_id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"])
    copies = stage(members.where("doc_id <> first").select("doc_id", "first").distinct(), "copies")
    others = copies.select("doc_id").join(classes.select(F.col("first").alias("doc_id")), "doc_id", "left_anti")
    useful = docs.where("doc_id IS NOT NULL")
    firsts = drop_ids(useful, stage(others.distinct(), "others"))
    repeated = not _repeated(sets).isEmpty()

    def listed(some: DataFrame, whole: bool = False) -> DataFrame:
        found = listings(some, like, whole)
        return found.dropDuplicates(["s1", "n", "token"]) if repeated else found

    named = classes.withColumnRenamed("first", "doc_id").drop("s2")
    prefix = stage(prefixes(listed(firsts), like).join(named, ["s1", "n"]).drop("s1"), "prefix")
    checked = stage(stars(prefix, like), "pairs")
    links = stage(verified(checked, useful, like), "links")
    placed = stage(met(prefix, components(links)), "met")
    crowded = stage(placed.where("crowded").select("doc_id", "part").distinct(), "crowded")
    again = listed(keep_ids(firsts, crowded.select("doc_id")), True).select("token", "s1", "n")
    whole = stage(again.join(named.join(crowded, "doc_id"), ["s1", "n"]), "whole")
    between = stage(prefixes_between(whole, like), "between")
    rest = pairs_met(placed, like).union(pairs_between(between, like)).join(checked, ["a", "b"], "left_anti")
    more = stage(verified(stage(rest, "pairs"), useful, like), "links")
    labels = components(links.union(more).union(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))))
    return sets.join(labels, sets["doc_id"] == labels["node"], "left").select(
        sets["doc_id"], F.col("n").alias("n_shingles"), F.coalesce("component_id", sets["doc_id"]).alias("component_id")
    )


def one_of_each(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """The documents, with all columns, without those that have a smaller doc_id in their component.

    Of rows that repeat a doc_id one stays, the smallest by text. Rows with a null doc_id stay.
    """
    found = stage(joined(docs, like), "joined")
    kept = drop_ids(docs, found.where("doc_id > component_id").select("doc_id").distinct())
    repeated = _repeated(found)
    if repeated.isEmpty():
        return kept
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    once = keep_ids(kept, repeated).withColumn("_llm_nth", nth).where("_llm_nth = 1").drop("_llm_nth")
    return drop_ids(kept, repeated).unionByName(once)
