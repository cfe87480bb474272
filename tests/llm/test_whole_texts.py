"""Texts that go whole through the vocabulary's ranks, against the way piece by piece."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import public_tokenizers

from tallyloom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
TEXTS = ["", "don't  stop\n\n 12345 x", "é🙂 ok 漢字　\x1c ﷺ", "<|endoftext|> \x00 ́ 👩‍👩‍👧", "  \t\r\n ", "z" * 5000, "!" * 70 + " ١٢٣ " * 9]


def piecewise(monkeypatch) -> bpe.Codec:
    monkeypatch.setattr(bpe, "WHOLE_CHARACTERS", -1)
    return bpe.Codec(PATH, PATTERN)


def test_texts_are_not_cut_into_pieces_here(monkeypatch):
    coder = bpe.Codec(PATH, PATTERN)
    found = [coder.ids(t) for t in TEXTS]
    assert not coder.known  # no piece was looked up or kept
    other = piecewise(monkeypatch)
    assert found == [other.ids(t) for t in TEXTS] and other.known
    assert [coder.decode(i).decode() for i in found] == TEXTS
    assert [coder.spell(i) for i in found] == [" ".join(map(str, i)) for i in found]


def test_a_long_run_of_blanks_is_coded(spark):
    text = "a" + " " * 1_500_000 + "b"
    row = bpe.round_trip(spark.createDataFrame([(text,)], "text string"), PATH, PATTERN).first()
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["n_tokens"] > 1


def test_pieces_of_long_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHARACTERS", 2_000)
    texts = [f"{'ab' * (20 + i)} some text" for i in range(60)]
    found = list(map(bpe.Codec(PATH, PATTERN).ids, texts))
    coder = piecewise(monkeypatch)
    for text, ids in zip(texts, found, strict=True):
        assert coder.ids(text) == ids and coder.kept < 4_000 and 0 < len(coder.known) < 30


def test_ids_that_are_no_ranks_are_not_taken_for_ranks(tmp_path):
    file = json.loads(Path(PATH).read_text())
    last = len(file["model"]["vocab"]) - 1
    file["model"]["vocab"] = {t: last - i for t, i in file["model"]["vocab"].items()}
    path = tmp_path / "turned.json"
    path.write_text(json.dumps(file))
    turned, straight = bpe.Codec(str(path), PATTERN), bpe.Codec(PATH, PATTERN)
    assert turned.whole is None
    for text in TEXTS:
        assert turned.ids(text) == [last - i for i in straight.ids(text)]
        assert turned.decode(turned.ids(text)) == text.encode()
