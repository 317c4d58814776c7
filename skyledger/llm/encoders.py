"""Token ids of whole Arrow batches of texts, by the given vocabulary files; nothing is trained.

A vocabulary's file is read in the workers, so its path must be there on every machine, as an installed package is.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from skyledger.llm import words as W
from skyledger.llm.token_rollup import BYTE_BPE_PATTERN

# Units whose ids a worker remembers, besides those of the piece at hand: some 60 MB.
REMEMBERED = 1_500_000
MARK = np.isin(np.arange(256), list(b".,;:!?"))
LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


def ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (n[i] of them), one after the other for all i."""
    n = n.astype(np.int64)
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(first - (ends - n), n)


class WordUnits:
    """A vocabulary that drops white space and case: a text's ids are those of its words, one after the other.

    Words lie between 0x09-0x0D and 0x20, and marks at the end of a word are units of their own. The vocabulary's
    rules (normal form, lower case, split, special tokens) never look across these borders. A unit is known by 64 bits
    of hash and encoded when it is first met; of a million units, two share a hash in one of 30 million cases.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark runs a worker on each core; threads of their own would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, units: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        at = np.append(self.at, np.arange(len(self.first) - 1, len(self.first) - 1 + len(units)))
        known = np.append(self.known, keys)
        order = np.argsort(known, kind="stable")
        self.known, self.at = known[order], at[order]
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))])

    def _is_known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(keys), bool)
        return self.known[np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)] == keys

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts with ``end_id`` after each, and the number of ids of each. Null texts are empty."""
        words = _same_case(_without_marks(W.split_words(texts)))
        codes, keys = pd.factorize(W.word_hashes(words))
        new = np.flatnonzero(~self._is_known(keys))
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = np.arange(len(keys))
        if len(new):
            some = np.zeros(len(keys), np.int64)
            some[codes] = np.arange(len(codes))
            raw, some = words.data.tobytes(), some[new]
            units = [raw[a:b].decode() for a, b in zip(words.start[some].tolist(), words.end[some].tolist())]
            self._learn(keys[new], units)
        at = self.at[np.searchsorted(self.known, keys)]
        first, size = self.first[at][codes], (self.first[at + 1] - self.first[at])[codes]
        tokens = np.bincount(words.row, size, minlength=words.rows).astype(np.int64)
        out = np.full(int(tokens.sum()) + words.rows, end_id, np.uint32)
        row = np.repeat(words.row, size)
        out[np.arange(len(row)) + row] = self.flat[ragged(first, size)]
        return out, tokens + 1


@lru_cache(1)
def word_units(path: str) -> WordUnits:
    """The vocabulary of this worker, which serves one task after the other."""
    return WordUnits(path)


def _without_marks(words: W.Words) -> W.Words:
    """Words of which up to four marks after an ASCII letter are cut off as a word of their own."""
    cut = words.end.copy()
    for _ in range(4):
        cut -= (cut - 1 > words.start) & MARK[words.data[cut - 1]]
    cut = np.where(LETTER[words.data[cut - 1]], cut, words.end)
    marked = cut < words.end
    order = np.argsort(np.concatenate([words.start, cut[marked]]), kind="stable")
    start = np.concatenate([words.start, cut[marked]])[order]
    end = np.concatenate([cut, words.end[marked]])[order]
    return W.Words(words.data, start, end, np.concatenate([words.row, words.row[marked]])[order], words.offsets)


def _same_case(words: W.Words) -> W.Words:
    """Words of ASCII in lower case, unless a special token may be near, which has a case."""
    if not len(words.start) or b"<|" in words.data.tobytes():
        return words
    data = W.LOWER[words.data]
    wide = words.data >= 128
    if wide.any():
        # A word and the ASCII after it, up to the next word.
        some = np.logical_or.reduceat(wide, words.start)
        at = ragged(words.start[some], (words.end - words.start)[some])
        data[at] = words.data[at]
    return W.Words(data, words.start, words.end, words.row, words.offsets)


# --- vocabularies that keep every byte ------------------------------------------------

# Runs of white space longer than this are beyond the stack of the faster coder.
LONG_SPACE = re.compile(r"\s{2000}")


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes.

    Printable bytes of Latin-1 stand for themselves; the others, in order, are the characters from 256 on.
    """
    own = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class TokenBytes:
    """The bytes of each id, and of any array of ids."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t[:1] == b" " for t in tokens])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.first[ids], self.length[ids])]


class BytePairs:
    """A byte-level vocabulary file; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        # The file's own coder takes any text, the other one is six times as fast.
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        byte = byte_characters()
        ids = self.slow.get_vocab(with_added_tokens=False)
        tokens = [b""] * self.slow.get_vocab_size(with_added_tokens=True)
        for token, i in ids.items():
            tokens[i] = bytes(byte[c] for c in token)
        ranks = {tokens[i]: i for i in ids.values()}
        self.fast = tiktoken.Encoding("pairs", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = TokenBytes(tokens)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [
            np.array(self.slow.encode(t, add_special_tokens=False).ids, np.int32)
            if LONG_SPACE.search(t)
            else np.array(self.fast.encode_ordinary(t), np.int32)
            for t in texts
        ]


class Pieces:
    """A sentence-piece model file with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                tokens.append(bytes([int(piece[3:-1], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                tokens.append(b"")
            else:
                tokens.append(piece.replace("▁", " ").encode())
        self.bytes = TokenBytes(tokens)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]
