"""Byte-level BPE: texts to token ids with offsets, and back.

The vocabulary file is a parameter and is read where the tasks run; nothing is trained.  A text goes whole through the
tiktoken library, which cuts it by the vocabulary's published pattern and merges each piece by the ids' order.  Texts too
long for its pattern engine, and vocabularies whose ids are not in merge order, take the other way: they are cut here, and
each distinct piece goes through the tokenizers library once per task process (a cache of bounded pieces and characters).
A token's bytes map to characters through the byte table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.frames import map_columns

#: Characters of the longest text that goes whole: tiktoken's pattern engine ends at a run of a million blanks or so.
WHOLE_CHARACTERS = 100_000
#: Pieces, and characters of pieces and ids, that a task process keeps; beyond either it starts anew.
CACHE_PIECES, CACHE_CHARACTERS = 200_000, 16 << 20


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is printable, else the next free one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Codec:
    """One vocabulary file of the tokenizers library, in a task process."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split = regex.compile(pattern).findall
        back = {c: b for b, c in byte_characters().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = {i: bytes(back[c] for c in token) for token, i in vocabulary.items() if all(c in back for c in token)}
        self.spelled = {i: str(i) for i in self.bytes}
        self.whole = self.by_ranks(path, pattern, vocabulary)
        self.known: dict[str, str] = {}
        self.kept = 0

    def by_ranks(self, path: str, pattern: str, vocabulary: dict[str, int]):
        """The vocabulary in the tiktoken library; None unless its ids are ranks: a byte each, then a merge each, in order."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        made = [vocabulary.get(m.replace(" ", "") if isinstance(m, str) else "".join(m), -1) for m in merges]
        ranks = {b: i for i, b in self.bytes.items()}
        single = [i for b, i in ranks.items() if len(b) == 1]
        in_order = len(single) == 256 and all(a < b for a, b in pairwise([max(single), *made]))
        if not in_order or len(ranks) != 256 + len(made) or self.tokenizer.normalizer is not None:
            return None
        return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def learn(self, pieces: set[str]) -> None:
        """Put new pieces' ids into the cache, which the pieces of one text may exceed."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > CACHE_PIECES or self.kept > CACHE_CHARACTERS:
            self.known.clear()
            self.kept = 0
            new = list(pieces)
        for piece, coded in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            ids = self.known[piece] = " ".join(map(str, coded.ids))
            self.kept += len(piece) + len(ids)

    def ids(self, text: str) -> list[int]:
        if self.whole and len(text) <= WHOLE_CHARACTERS:
            return self.whole.encode_ordinary(text)
        pieces = self.split(text)
        self.learn(set(pieces))
        return list(map(int, " ".join(map(self.known.__getitem__, pieces)).split()))

    def spell(self, ids: Sequence[int]) -> str:
        """Ids as decimal numbers joined by spaces."""
        return " ".join(map(self.spelled.__getitem__, ids))

    def offsets(self, ids: Sequence[int], text: str) -> list[tuple[int, int]]:
        """First character and end of the characters that each token's bytes touch."""
        data = text.encode("utf-8")
        character, n = [], -1
        for byte in data:
            n += (byte & 0xC0) != 0x80
            character.append(n)
        spans, at = [], 0
        for i in ids:
            end = at + len(self.bytes[i])
            spans.append((character[at], character[end - 1] + 1))
            at = end
        return spans

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> Codec:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    return Codec(path, pattern)


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = True, keep: Sequence[str] | None = None
) -> DataFrame:
    """Adds `ids` (array<int>) and, if asked for, `starts` and `ends` (array<int>, characters) to every row.

    A null or empty text has empty arrays.  A token that holds part of a character spans that whole character.
    Rows are independent: repeated rows, ties and an empty table need no rule; kept columns named like added ones give
    way.
    """

    def compute(texts):
        coder = codec(path, pattern)
        ids = [coder.ids(t) if t else [] for t in texts]
        if not offsets:
            return [ids]
        spans = [coder.offsets(i, t) if t else [] for i, t in zip(ids, texts)]
        return ids, [[s for s, _ in x] for x in spans], [[e for _, e in x] for x in spans]

    schema = "ids array<int>, starts array<int>, ends array<int>" if offsets else "ids array<int>"
    return map_columns(df, schema, compute, [text], keep)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `decoded` (string) from token ids; bytes of tokens join before they become characters, so characters that
    are split over tokens come back whole.  Bytes that make no character (ids cut in its middle) become U+FFFD.  Null
    ids give a null."""

    def compute(rows):
        coder = codec(path, pattern)
        return [[None if r is None else coder.decode(r).decode("utf-8", "replace") for r in rows]]

    return map_columns(df, "decoded string", compute, [ids], keep)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `n_tokens`, `ids_sha256` (of the decimal ids joined by one space) and `decoded_sha256` (of the decoded
    bytes): encodes every whole text and decodes its ids again.  A null text counts as empty."""

    def compute(texts):
        coder = codec(path, pattern)
        counts, coded, decoded = [], [], []
        for t in texts:
            ids = coder.ids(t or "")
            counts.append(len(ids))
            coded.append(hashlib.sha256(coder.spell(ids).encode()).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return pa.array(counts, pa.int64()), coded, decoded

    return map_columns(df, "n_tokens long, ids_sha256 string, decoded_sha256 string", compute, [text], keep)
