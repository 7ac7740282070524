"""Token ids and token counts of whole texts, exactly as the tokenizer libraries give them.

Both encoders cut a text at spaces where no token can reach across, and remember what they found
for a word. A word costs a dictionary lookup then, and no text is handed to a library in one piece
unless it has no safe place to cut. ``TABLE`` bounds how many words of at most ``LONGEST`` characters a
Python worker remembers.
"""

from __future__ import annotations

import json
import os
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

TABLE = 600_000
LONGEST = 64
# For what is of few kinds: punctuation, words at the start of a line or text.
FEW = 10_000
WINDOW = 1 << 20


def locate(name: str) -> str:
    """Path of a vocabulary file: an absolute path as it is, else a file of ``public_tokenizers``."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memo(dict):
    """Remembers what ``find`` gives for a key, in two generations of ``size`` keys.

    When the younger is full it becomes the older one; what the older one held and nobody asked for again is
    forgotten. Long keys, which hardly come again, are not remembered, so bytes are bounded with the keys.
    """

    def __init__(self, find, size: int | None = None):
        super().__init__()
        self.find, self.size, self.older = find, size or TABLE // 2, {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.find(key)
        if len(key) <= LONGEST:
            if len(self) >= self.size:
                self.make_room()
            self[key] = value
        return value

    def make_room(self, more: int = 1) -> None:
        if len(self) + more > self.size:
            self.older = dict(self)
            self.clear()


def windows(text: str, cut: re.Pattern, size: int = WINDOW) -> Iterator[str]:
    """The text in parts of about ``size`` characters, each next part starting at a match of ``cut``."""
    start = 0
    while len(text) - start > size:
        found = cut.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


class PieceCounter:
    """Token counts by a sentencepiece model.

    A space becomes a mark that starts a piece; the pieces of the vocabulary show whether one may hold
    a mark after another character. If none does, the text before `` x`` and the rest are independent,
    and the rest without its space gets the same mark from the library. Where a model allows no such
    cut, texts are encoded whole.
    """

    MARK = "▁"
    CUT = re.compile(f"(?<=[^ {MARK}])(?= [^ {MARK}])")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        marks = self.model.encode("a", out_type=str)[0].startswith(self.MARK)
        plain = self.model.encode("a  b", out_type=str) != self.model.encode("a b", out_type=str)
        self.splits = marks and plain and not any(re.search(f"[^{self.MARK}]{self.MARK}", p) for p in pieces)
        self.known = _Memo(self._word)

    def _word(self, word: str) -> int | None:
        """Tokens of the word with the mark before it; None where its spaces are no safe cuts."""
        if not word or word[0] == self.MARK or word[-1] == self.MARK:
            return None
        return len(self.model.encode(word))

    def __call__(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        return [self._count(text) for text in texts]

    def _count(self, text: str) -> int:
        first, *more = windows(text, self.CUT)
        return self._window(first) + sum(self._window(window[1:]) for window in more)

    def _window(self, text: str) -> int:
        self._learn(words := text.split(" "))
        try:
            return sum(map(self.known.__getitem__, words))
        except TypeError:
            parts = self.CUT.split(text)
            return len(self.model.encode(parts[0])) + sum(len(self.model.encode(p[1:])) for p in parts[1:])

    def _learn(self, words: list[str]) -> None:
        """One library call for all words of the window that are new."""
        known, mark = self.known, self.MARK
        new = [w for w in set(words) if 0 < len(w) <= LONGEST and w not in known and w[0] != mark and w[-1] != mark]
        new = [w for w in new if w not in known.older][: known.size]
        known.make_room(len(new))
        known.update(zip(new, map(len, self.model.encode(new, num_threads=1)), strict=True))


class ByteLevelEncoder:
    """Little-endian 32-bit ids by a ``tokenizers`` file.

    For byte-level models without normaliser a single space between two other characters always opens
    a new part of the library's splitting pattern, and letters are split from the punctuation behind
    them. Words of plain letters go straight to the model; all else goes through the whole tokenizer.
    """

    CUT = re.compile(r"(?<=\S)(?= \S)")
    # Latin letters without the two signs among them, and punctuation behind; an apostrophe may join letters.
    WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)((?:[!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)?)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        split = said.get("pre_tokenizer") or {}
        self.splits = (
            said.get("normalizer") is None
            and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) == ("ByteLevel", False, True)
            and said["model"]["type"] == "BPE"
            and not any(said["model"].get(k) for k in ("dropout", "ignore_merges", "unk_token"))
            and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in said["added_tokens"])
            # None of the added tokens may lie within a word as the pattern takes it.
            and not any(self.WORD.fullmatch(f"a{t['content']}") for t in said["added_tokens"])
        )
        if self.splits:
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in said["model"]["merges"]]
            self.model = models.BPE(said["model"]["vocab"], merges, cache_capacity=0)
            self.bytes = _byte_letters()
            self.space = self.bytes[ord(" ")]
            self.others, self.starts = _Memo(self._whole, FEW), _Memo(self._letters, FEW)
            self.known = _Memo(self._word)

    def __call__(self, text: str) -> bytes:
        if not self.splits:
            return self._whole(text)
        return b"".join(map(self._window, windows(text, self.CUT)))

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        spelled = (word if word.isascii() else word.encode().decode("latin-1")).translate(self.bytes)
        return array("I", map(_ID, self.model.tokenize(spelled))).tobytes()

    def _word(self, word: str) -> bytes | None:
        """Ids of the word with a space before it; None where its spaces are no safe cuts."""
        if word.isascii() and word.isalpha():
            # Letters spell themselves, and the space has the one spelling.
            return array("I", map(_ID, self.model.tokenize(self.space + word))).tobytes()
        if parts := self.WORD.fullmatch(word):
            letters, tail = parts.groups()
            return self.known[letters] + self.others[tail] if tail else self._letters(" " + letters)
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        head, *lines = word.split("\n")
        if lines and head and not any(not p or p[0].isspace() or p[-1].isspace() for p in (head, *lines)):
            # A single line end between two other characters is a part of its own.
            return self.known[head] + b"".join(self.others["\n"] + self._line(line) for line in lines)
        return self._whole(" " + word)

    def _line(self, word: str) -> bytes:
        parts = self.WORD.fullmatch(word)
        if parts is None:
            return self._whole(word)
        return self.starts[parts[1]] + (self.others[parts[2]] if parts[2] else b"")

    def _window(self, text: str) -> bytes:
        first, *words = text.split(" ")
        if not words:
            return self._whole(text)
        last = words.pop()
        if not first[-1:].isspace() and last and not last[0].isspace():
            tail = self._whole(" " + last) if last[-1].isspace() else self.known[last]
            try:
                return self.others[first] + b"".join(map(self.known.__getitem__, words)) + tail
            except TypeError:
                pass
        return b"".join(map(self._part, self.CUT.split(text)))

    def _part(self, part: str) -> bytes:
        if part[:1] == " " and " " not in part[1:] and (found := self.known[part[1:]]) is not None:
            return found
        return self._whole(part)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ID = attrgetter("id")


def _byte_letters() -> dict[int, str]:
    """How byte-level models spell a byte: printable ones as themselves, the others from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def encoder(name: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(locate(name))


@lru_cache(maxsize=4)
def counter(name: str):
    """Counts of tokens for a list of texts, by the library that the file is for."""
    if name.endswith(".model"):
        return PieceCounter(locate(name))
    encode = encoder(name)
    return lambda texts: [len(encode(text)) // 4 for text in texts]
