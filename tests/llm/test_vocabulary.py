"""Token ids and counts against the libraries themselves, over texts made of awkward parts."""

from __future__ import annotations

import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from yieldlens.llm import vocabulary

PARTS = [
    "the", "The", "word", "naïve", "Straße", "été", "a×b", "x÷", "it's", "don't", "we'll", "'s", "s's'", "123", "4x5",
    "the.\nThe", "a\nb\nc", "\nx", " ", "  ", "   ", "\n", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "▁", "▁▁",
    ".", ",", "...", "!!", "%%%", "_", "__", "-", "#", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "日本語", "🙂", "́", "\x00",
]


def texts(seed: int, n: int) -> list[str]:
    choose = random.Random(seed)
    made = ["".join(choose.choices(PARTS, k=choose.randint(0, 12))) for _ in range(n)]
    return made + [" ".join(choose.choices(PARTS, k=choose.randint(0, 12))) for _ in range(n)] + ["", " ", "  ", "\n "]


@pytest.mark.parametrize("window", [5, 1 << 20])
def test_ids_are_those_of_the_library(window, monkeypatch):
    monkeypatch.setattr(vocabulary.windows, "__defaults__", (window,))
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, library = vocabulary.ByteLevelEncoder(path), Tokenizer.from_file(path)
    assert encode.splits
    for text in texts(1, 3000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


@pytest.mark.parametrize("window", [5, 1 << 20])
def test_counts_are_those_of_the_library(window, monkeypatch):
    monkeypatch.setattr(vocabulary.windows, "__defaults__", (window,))
    path = public_tokenizers.path("piece_bpe_32k.model")
    count, library = vocabulary.PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert count.splits
    made = texts(2, 3000)
    assert [n for t in made for n in count([t])] == [len(library.encode(t)) for t in made]


def test_a_file_without_safe_cuts_is_used_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, library = vocabulary.ByteLevelEncoder(path), Tokenizer.from_file(path)
    assert not encode.splits
    for text in texts(3, 200):
        ids = library.encode(text, add_special_tokens=False).ids
        assert encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(vocabulary, "TABLE", 10)
    path = public_tokenizers.path("piece_bpe_32k.model")
    count, library = vocabulary.PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)
    text = " ".join(f"w{i}" for i in range(200))
    assert count([text, text]) == [len(library.encode(text))] * 2 and len(count.known) + len(count.known.older) <= 10


def test_plain_letters_go_straight_to_the_model(monkeypatch):
    encode = vocabulary.ByteLevelEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Some plain words and Some more of them"
    wanted = encode.tokenizer.encode(text, add_special_tokens=False).ids
    encode.known["Some"], encode.others["Some"]
    # What spells words by the table of bytes is for other letters.
    monkeypatch.setattr(encode, "_letters", None)
    assert list(struct.unpack(f"<{len(wanted)}I", encode(text))) == wanted
