"""Token alignment against direct encoding and a byte-by-byte comparison."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyledger.llm import alignment, encoders, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CODER, MODEL = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
CODER.encode_special_tokens = True
# The bytes that byte-level vocabularies write as themselves.
OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE = {chr(b): b for b in OWN}
BYTE |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in OWN)}
ODD = [
    None, "", " ", "  a  b ", "\n\n\t x\r\n", "▁marked ▁", "<|endoftext|> <s> </s> <unk> <0x41>", "naïve café 文字 😀 ﬁ ½",
    "a\x00b", "x" * 300, " " * 3000 + "y", "é   　z", "don't stop, it's 12,345.67!", "same same same",
]


def tokens_of(text):
    whole = (" " + text).encode() if text else b""
    a = [(i, bytes(BYTE[c] for c in CODER.id_to_token(i))) for i in CODER.encode(" " + text, add_special_tokens=False).ids] if text else []
    b = []
    for i in MODEL.encode(text) if text else []:
        piece = MODEL.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if MODEL.is_byte(i) else piece.replace("▁", " ").encode()))
    if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
        return [], []
    return a, b


def brute(texts):
    """For each text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    each, counts = [], Counter()
    for text in texts:
        a, b = tokens_of(text)
        ends = []
        for tokens in (a, b):
            at, places = 0, []
            for _, t in tokens:
                at += len(t)
                places.append(at)
            ends.append(places)
        shared = sorted(set(ends[0]) & set(ends[1]))
        links = [(a[ends[0].index(x)][0], b[ends[1].index(x)][0]) for x in shared]
        groups, low = [], 0
        for x in shared:
            pick = lambda tokens, places: ",".join(str(t[0]) for t, e in zip(tokens, places) if low < e <= x)  # noqa: B023, E731
            groups.append(f"{pick(a, ends[0])}|{pick(b, ends[1])}")
            low = x
        counts.update(links)
        each.append((len(a), len(b), len(shared), links, ";".join(groups)))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (n_a, n_b, n, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), groups)
        for n_a, n_b, n, links, groups in each
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("hot", [alignment.HOT, 10, 0])
def test_odd_texts_as_by_brute_force(spark, hot):
    schema = "doc_id long, text string, pairs string, row int, n long, times string"
    texts = [*ODD, "same same same", "Same text twice", "Same text twice"]
    docs = spark.createDataFrame([(i if i else None, t, "x", 1, 2, "y") for i, t in enumerate(texts)], schema).repartition(3)
    found = alignment.scored(docs, A, B, hot=hot)
    assert found.columns == ["doc_id", *COLUMNS]
    rows = {r.doc_id or 0: tuple(r)[1:] for r in found.collect()}
    assert len(rows) == found.count() == len(texts)
    for i, wanted in enumerate(brute(texts)):
        assert rows[i] == wanted, texts[i]
    assert rows[5][0] == 0 and rows[6][0] > 0
    assert alignment.scored(docs.where("false"), A, B, hot=hot).collect() == []


def test_whole_table_as_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = queries.op13_token_alignment(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", *COLUMNS[:-1], "groups_sha256"]
    rows = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    some = {d.doc_id: d.text for d in docs}
    for doc_id, wanted in zip(some, brute(some.values())):
        digest = hashlib.sha256(wanted[-1].encode()).hexdigest() if wanted[-1] else ""
        assert rows[doc_id] == (*wanted[:-1], digest)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab cé文.\n\t ▁'1")), max_size=30), max_size=5))
def test_any_texts_are_aligned(texts):
    found = BOTH.aligned(texts)
    wanted = brute(texts)
    assert [g.decode() for g in found["groups"]] == [w[-1] for w in wanted]
    assert found["n_links"].tolist() == [w[3] for w in wanted]
    assert found["n_a"].tolist() == [w[0] for w in wanted]
    assert found["times"].sum() == sum(w[3] for w in wanted)


BOTH = alignment.Aligner(A, B)


def test_windows_are_learnt_again_when_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    both = alignment.Aligner(A, B)
    for texts in (["one two three"], ["three four five " * 9, "one"], ["x" * 200 + " one two"], ["one two three"]):
        assert [g.decode() for g in both.aligned(texts)["groups"]] == [w[-1] for w in brute(texts)]


def test_long_white_space_is_encoded_alike():
    pairs = encoders.BytePairs(A)
    for text in (" a" + " " * 2500 + "b", " " + "\n" * 2000, " a  b" + " " * 1999 + "c"):
        assert pairs.encode([text])[0].tolist() == CODER.encode(text, add_special_tokens=False).ids
