"""Two tokenizers' tokens of the same text, side by side.

Each library says which characters a token covers. Those spans are coarse cuts: a character of several bytes may
be shared by tokens that split it, and a byte-fallback token covers no character of its own. A cut is taken
where what the tokens since the last one decode to is exactly the text there; within such a run the decoded
bytes tell where each token ends. Where tokens of both sides end together, the text falls apart into groups.

Words between single blanks, and lines, are cut off before: no token of either side reaches across, which the
vocabularies are asked for. What a word aligns to is remembered, so common words cost a look-up.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldlens.llm import vocabulary
from yieldlens.llm.storage import Workspace
from yieldlens.llm.token_counts import by_bytes
from yieldlens.llm.vocabulary import locate, windows

SLICE_BYTES = 1 << 20
# Texts that share one table of id pairs: so many bytes, or one longer text.
BLOCK_BYTES = 4 << 20
# Words whose alignment a Python worker remembers; each takes some 500 bytes.
WORDS = 400_000

_MARK = "▁"
# Two blanks, a blank at the end or beside other white space, or the mark that stands for a blank.
_ODD = re.compile(rf" (?:\s|\Z)|[^\S ](?: |\Z)|{_MARK}")


def refined(cuts: Sequence[int], pieces: Sequence[bytes], data: bytes) -> list[int] | None:
    """Where each token ends in ``data``, from the coarse ``cuts`` (bytes) behind the tokens and what they decode to.

    None where the tokens do not decode to the data.
    """
    ends: list[int] = []
    start, run = 0, []
    for cut, piece in zip(cuts, pieces, strict=True):
        run.append((run[-1] if run else start) + len(piece))
        if run[-1] == cut and data[start:cut] == b"".join(pieces[len(ends) : len(ends) + len(run)]):
            ends += run
            start, run = cut, []
    if run:
        if data[start:] != b"".join(pieces[len(ends) :]):
            return None
        ends += run
    return ends if start == len(data) or run else None


@dataclass(frozen=True)
class Spans:
    """The tokens of one text: ids, and the byte behind each."""

    ids: list[int]
    ends: list[int]


class TokenizersSide:
    """Spans by a file of the tokenizers library, for a text that begins with a blank. Special strings are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        split = said.get("pre_tokenizer") or {}
        if split.get("type") != "ByteLevel":
            raise ValueError("tokens that are no plain bytes can not be aligned")
        # Byte-level models without normaliser: a blank between two other characters opens a new part.
        self.splits = said.get("normalizer") is None and not split.get("add_prefix_space") and bool(split.get("use_regex"))
        added = [t["content"] for t in said.get("added_tokens", [])]
        self.plain = self.splits and said["model"]["type"] == "BPE" and not any(t.strip().isalpha() for t in added)
        spelled_as = vocabulary._byte_letters()
        letters, self.blank = {letter: byte for byte, letter in spelled_as.items()}, spelled_as[ord(" ")]
        self.pieces = [b""] * self.tokenizer.get_vocab_size()
        for piece, id_ in self.tokenizer.get_vocab().items():
            # An added token stands for itself; none is ever found in a text.
            spelled = all(c in letters for c in piece)
            self.pieces[id_] = bytes(letters[c] for c in piece) if spelled else piece.encode()

    def ids(self, texts: list[str], bare: bool) -> list[list[int]]:
        """Ids alone, without asking for spans."""
        plain = [self.plain and not bare and text.isascii() and text[:1] == " " and text[1:].isalpha() for text in texts]
        rest = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        # A blank and letters are one part of the library's splitting pattern: they go straight to its model.
        tokens = self.tokenizer.model.tokenize
        return [[x.id for x in tokens(self.blank + t[1:])] if p else next(rest).ids for t, p in zip(texts, plain, strict=True)]

    def coarse(self, texts: list[str], bare: bool) -> list[tuple[list[int], list[int]]]:
        """Ids and the characters behind them. ``bare`` texts stand behind a line end, others have their blank."""
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [(f.ids, [end for _, end in f.offsets]) for f in found]

    def spans(self, texts: list[str], bare: bool) -> list[Spans | None]:
        out = []
        for text, (ids, cuts) in zip(texts, self.coarse(texts, bare), strict=True):
            data = text.encode()
            out.append(_side(ids, cuts if len(data) == len(text) else _in_bytes(text, cuts), self.pieces, data))
        return out


class SentencepieceSide:
    """Spans by a sentencepiece model, which puts a blank before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(_MARK, " ").encode() for i, name in enumerate(names)
        ]
        # Those that a text can hold.
        odd = (self.model.is_control, self.model.is_unknown, self.model.is_byte)
        self.texts = [name for i, name in enumerate(names) if not any(is_(i) for is_ in odd)]
        begins = self.model.encode("a", out_type=str)[0].startswith(_MARK)
        keeps = self.model.encode("a  b") != self.model.encode("a b")
        within = any(re.search(f"[^{_MARK}]{_MARK}", name) for name in names)
        self.splits = begins and keeps and not within and not any("\n" in name for name in names)
        # What comes before the tokens of a text that stands behind a line end.
        self.line = self.model.encode("\n")

    def ids(self, texts: list[str], bare: bool) -> list[list[int]]:
        """Ids alone, without asking for spans; of a ``bare`` text without those of the line end."""
        asked = ["\n" + text for text in texts] if bare else [text[1:] for text in texts]
        found = self.model.encode(asked, out_type=int, num_threads=1)
        return [f[len(self.line) :] for f in found] if bare else found

    def coarse(self, texts: list[str], bare: bool) -> list[tuple[list[int], list[int]]]:
        """Ids and the bytes behind them; of a ``bare`` text without those of the line end."""
        asked = ["\n" + text for text in texts] if bare else [text[1:] for text in texts]
        skip, more = (len(self.line), -1) if bare else (0, 1)
        out = []
        for found in self.model.encode(asked, return_type="proto", num_threads=1):
            pieces = found.pieces[skip:] if skip else found.pieces
            out.append(([p.id for p in pieces], [p.end + more for p in pieces]))
        return out

    def spans(self, texts: list[str], bare: bool) -> list[Spans | None]:
        return [
            _side(ids, cuts, self.pieces, text.encode()) for text, (ids, cuts) in zip(texts, self.coarse(texts, bare), strict=True)
        ]


def _side(ids: list[int], cuts: list[int], pieces: list[bytes], data: bytes) -> Spans | None:
    ends = refined(cuts, [pieces[i] for i in ids], data)
    return None if ends is None else Spans(ids, ends)


def _in_bytes(text: str, places: list[int]) -> list[int]:
    """Places in characters as places in bytes."""
    ends = [0, *accumulate(map(len, map(str.encode, text)))]
    return [ends[p] for p in places]


@lru_cache(maxsize=4)
def side(name: str) -> TokenizersSide | SentencepieceSide:
    return (SentencepieceSide if name.endswith(".model") else TokenizersSide)(locate(name))


class Aligned(NamedTuple):
    """Both sides' tokens in a stretch of text, as groups ``a1,a2|b1;a3|b2``, and the pairs of tokens that overlap."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


# The fields of an Aligned. What is remembered are plain tuples, which Python's collector does not go through again and again.
Part = tuple[int, int, int, str, bytes]


def aligned(a: Spans, b: Spans, ids_b: int) -> Part:
    """Between one end of either side and the next lies one token of each: a link.

    It is written as id of A times ``ids_b`` plus id of B.
    """
    groups, links = [], []
    i = j = first_a = first_b = 0
    while i < len(a.ids) and j < len(b.ids):
        links.append(a.ids[i] * ids_b + b.ids[j])
        end_a, end_b = a.ends[i], b.ends[j]
        i += end_a <= end_b
        j += end_b <= end_a
        if end_a == end_b:
            groups.append(",".join(map(str, a.ids[first_a:i])) + "|" + ",".join(map(str, b.ids[first_b:j])))
            first_a, first_b = i, j
    return len(a.ids), len(b.ids), len(groups), ";".join(groups), np.array(links, np.int64).tobytes()


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal numbers up to ``most`` as rows of characters, with room for one more, and how many each has."""
    text = np.arange(most).astype(bytes)
    rows = np.zeros((most, text.itemsize + 1), np.uint8)
    rows[:, :-1] = text.view(np.uint8).reshape(most, -1)
    return rows, np.char.str_len(text)


def aligned_plain(
    sizes: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], ids_b: int, numbers: tuple[np.ndarray, np.ndarray]
) -> list[Part]:
    """``aligned`` for many texts of so many bytes at once: ids and ends of both sides, the ends counted through all texts."""
    bounds = np.cumsum(sizes)
    every, common = np.union1d(a[1], b[1]), np.intersect1d(a[1], b[1], assume_unique=True)
    links = a[0][np.searchsorted(a[1], every)] * ids_b + b[0][np.searchsorted(b[1], every)]
    # Tokens by group, those of A first.
    group = np.concatenate([2 * np.searchsorted(common, a[1]), 2 * np.searchsorted(common, b[1]) + 1])
    order = np.argsort(group, kind="stable")
    group, ids = group[order], np.concatenate([a[0], b[0]])[order]
    rows, widths = numbers[0][ids], numbers[1][ids]
    last = np.append(group[1:] != group[:-1], True)
    rows[np.arange(len(ids)), widths] = np.where(last, np.where(group % 2, ord(";"), ord("|")), ord(","))
    text = rows[np.arange(rows.shape[1]) <= widths[:, None]].tobytes().decode("ascii")
    written = np.cumsum(widths + 1)
    # Each text ends with a group, whose number tells where its last token stands.
    groups = np.searchsorted(common, bounds) + 1
    texts = written[np.searchsorted(group, 2 * groups) - 1]
    columns = [np.diff(np.append(0, x)).tolist() for x in (np.searchsorted(a[1], bounds) + 1, np.searchsorted(b[1], bounds) + 1, groups)]
    packed, places = links.tobytes(), (8 * (np.searchsorted(every, bounds) + 1)).tolist()
    texts = texts.tolist()
    return [
        (n_a, n_b, n_groups, text[t:u - 1], packed[x:y])
        for n_a, n_b, n_groups, t, u, x, y in zip(*columns, [0, *texts[:-1]], texts, [0, *places[:-1]], places, strict=True)
    ]


def _joined(parts: list[Part]) -> Part:
    if len(parts) == 1:
        return parts[0]
    n_a, n_b, n_groups, groups, links = zip(*parts, strict=True)
    return sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links)


class Aligner:
    """Alignments of whole texts, each with a blank before it."""

    # Both libraries begin a new token at a single blank between two other characters.
    CUT = re.compile(rf"(?<=[^\s{_MARK}])(?= [^\s{_MARK}])")
    # Latin letters without the two signs among them, and punctuation behind; an apostrophe may join letters.
    WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")

    def __init__(self, left: str, right: str):
        self.a, self.b = side(left), side(right)
        self.ids_b = len(self.b.pieces)
        self.numbers = _digits(max(len(self.a.pieces), self.ids_b))
        self.sizes = [np.array([len(p) for p in s.pieces]) for s in (self.a, self.b)]
        self.splits = self.a.splits and self.b.splits
        # A splits letters from punctuation behind them before it looks for tokens; so does B if no token holds both.
        both = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ][!-&(-/:-@\\[-`{-~]")
        self.parts = self.splits and not any(both.search(p) for p in self.b.texts)
        # What stands behind a blank, and what stands behind a line end or letters.
        self.words = vocabulary._Memo(self._word, WORDS // 2)
        self.bare = vocabulary._Memo(lambda text: self._whole([text], True)[0], WORDS // 16)
        self.line = self._whole(["\n"], True)[0]

    def learn(self, texts: list[str]) -> None:
        """What is new in the texts, in few calls of the libraries."""
        if not self.splits:
            return
        words, bare = set(), set()
        known = self.words
        for word in set().union(*(t.split(" ") for t in texts)):
            if word in known:
                continue
            if word in known.older:
                # Asked for again: brought over before room for new words is made.
                known[word]
                continue
            if word.isalpha() or self._odd(word):
                words.add(word)
                continue
            head, *lines = word.split("\n")
            for new, part in ((words, head), *((bare, line) for line in lines)):
                parts = self.WORD.fullmatch(part) if self.parts else None
                new.add(parts[1] if parts else part)
                if parts:
                    bare.add(parts[2])
        for memo, new, before in ((self.words, words, " "), (self.bare, bare, "")):
            for word in new:
                if word in memo.older:
                    memo[word]
            new = [w for w in new if 0 < len(w) <= vocabulary.LONGEST and w not in memo and w not in memo.older][: memo.size]
            memo.make_room(len(new))
            for at in range(0, len(new), 2000):
                some = new[at : at + 2000]
                memo.update(zip(some, self._plain([before + w for w in some], not before), strict=True))

    def __call__(self, text: str) -> Aligned | None:
        """None for an empty text, and where either side's tokens do not decode to the text with its blank."""
        if not text:
            return None
        if not self.splits:
            found = self._whole([" " + text], False)[0]
            return None if found is None else Aligned(*found)
        done = []
        for part in windows(" " + text, self.CUT):
            found = self._window(part)
            if found is None:
                return None
            done.append(found)
        return Aligned(*_joined(done))

    def _plain(self, texts: list[str], bare: bool) -> list[Part | None]:
        """``_whole`` for many texts: where both sides' tokens decode to the text, all are aligned at once.

        There the decoded bytes tell every end, whatever the libraries' spans say, so these are not asked for.
        """
        if not texts:
            return []
        data = [t.encode() for t in texts]
        sizes, found = np.array([len(d) for d in data]), []
        good = sizes > 0
        for s, widths in zip((self.a, self.b), self.sizes, strict=True):
            listed = s.ids(texts, bare)
            text_of = np.repeat(np.arange(len(texts)), [len(i) for i in listed])
            ids = np.fromiter(chain.from_iterable(listed), np.int64, len(text_of))
            good &= np.bincount(text_of, widths[ids], len(texts)) == sizes
            found.append((ids, text_of))
        sides, whole = [], b"".join(d for d, g in zip(data, good.tolist(), strict=True) if g)
        for (ids, text_of), s, widths in zip(found, (self.a, self.b), self.sizes, strict=True):
            ids = ids[good[text_of]]
            sides.append((ids, np.cumsum(widths[ids])))
            if b"".join(map(s.pieces.__getitem__, ids.tolist())) != whole:
                return self._whole(texts, bare)
        out: list[Part | None] = [None] * len(texts)
        places = np.flatnonzero(good).tolist()
        if places:
            for place, one in zip(places, aligned_plain(sizes[good], *sides, self.ids_b, self.numbers), strict=True):
                out[place] = one
        odd = np.flatnonzero(~good).tolist()
        for place, one in zip(odd, self._whole([texts[i] for i in odd], bare), strict=True):
            out[place] = one
        return out

    def _whole(self, texts: list[str], bare: bool) -> list[Part | None]:
        if not texts:
            return []
        both = zip(self.a.spans(texts, bare), self.b.spans(texts, bare), strict=True)
        return [None if x is None or y is None else aligned(x, y, self.ids_b) for x, y in both]

    def _window(self, text: str) -> Part | None:
        """The text begins with a blank."""
        words = text[1:].split(" ")
        if not _ODD.search(text):
            found = list(map(self.words.__getitem__, words))
        else:
            found = self._whole(self.CUT.split(text), False)
        return None if None in found else _joined(found)

    @staticmethod
    def _odd(word: str) -> bool:
        """Whether there are lines that can not be taken one by one: an empty one, or white space or the mark at their ends."""
        parts = word.split("\n")
        return len(parts) > 1 and not all(p and not p[0].isspace() and not p[-1].isspace() and _MARK not in p for p in parts)

    def _word(self, word: str) -> Part | None:
        """What stands behind a blank, up to the next."""
        parts = self.WORD.fullmatch(word) if self.parts else None
        if parts:
            a, b = self.words[parts[1]], self.bare[parts[2]]
            if a is None or b is None:
                return None
            return a[0] + b[0], a[1] + b[1], a[2] + b[2], f"{a[3]};{b[3]}", a[4] + b[4]
        head, *lines = word.split("\n")
        if not lines or self._odd(word):
            return self._whole([" " + word], False)[0]
        # A single line end between two other characters is a token of its own on both sides.
        found = [self.words[head]]
        for line in lines:
            parts = self.WORD.fullmatch(line) if self.parts else None
            found += [self.line, *(map(self.bare.__getitem__, parts.groups()) if parts else [self.bare[line]])]
        return None if None in found else _joined(found)


@lru_cache(maxsize=2)
def aligner(left: str, right: str) -> Aligner:
    return Aligner(left, right)


_SPANS = "array<struct<id:int,end:bigint>>"


def token_spans(docs: DataFrame, left: str, right: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Both sides' tokens of every text with a blank before it: ``key``, ``a`` and ``b``, arrays of id and the byte behind it.

    A null or empty text, and one that either side's tokens do not decode to, has no tokens. Null keys are kept;
    repeated rows give a row each; other columns are not read; no documents give no rows.
    """
    schema = T.StructType([docs.schema[key], *(T.StructField(n, T.StructType.fromDDL(f"x {_SPANS}")[0].dataType) for n in "ab")])
    kind = pa.list_(pa.struct([("id", pa.int32()), ("end", pa.int64())]))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = side(left), side(right)
        for whole in batches:
            for batch in by_bytes(whole, SLICE_BYTES):
                columns = [], []
                for value in batch.column(1).to_pylist():
                    found = [s.spans([" " + value], False)[0] if value else None for s in sides]
                    for column, one in zip(columns, found, strict=True):
                        column.append([] if None in found else [{"id": i, "end": e} for i, e in zip(one.ids, one.ends, strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, kind) for c in columns)], names=schema.names)

    return docs.select(key, F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(spans, schema)


# What a row of ``_blocks`` has besides the key: those of a document, then those of an id pair of its block.
_DOCUMENT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links array<int>"
_PAIR = "block bigint, place int, pair bigint, n bigint"


def _blocks(docs: DataFrame, left: str, right: str) -> DataFrame:
    """Documents (first column the key, second the text) with their links as numbers of id pairs, and each block's pairs.

    A block is what a task has read one after another, up to BLOCK_BYTES; its pairs are numbered in their order.
    """
    key = docs.schema[0]
    schema = T.StructType([key, *T.StructType.fromDDL(f"{_DOCUMENT}, {_PAIR}").fields])
    kind = docs.limit(0).toArrow().schema.field(0).type
    kinds = [kind, *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def rows(size: int, **columns) -> pa.RecordBatch:
        arrays = [columns[f.name] if f.name in columns else pa.nulls(size, k) for f, k in zip(schema, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names=schema.names)

    def flushed(number: int, keys: list[pa.Array], done: list[Aligned | None]) -> Iterator[pa.RecordBatch]:
        found = [a or Aligned(0, 0, 0, "", b"") for a in done]
        links = np.frombuffer(b"".join(a.links for a in found), np.int64)
        pairs, places, times = np.unique(links, return_inverse=True, return_counts=True)
        sizes = [len(a.links) // 8 for a in found]
        ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
        yield rows(
            len(found),
            **{key.name: pa.concat_arrays(keys)},
            n_a=[a.n_a for a in found],
            n_b=[a.n_b for a in found],
            n_groups=[a.n_groups for a in found],
            n_links=sizes,
            groups=[a.groups for a in found],
            links=pa.ListArray.from_arrays(ends, pa.array(places, pa.int32())),
            block=np.full(len(found), number),
        )
        for at in range(0, len(pairs), 50_000):
            some = pairs[at : at + 50_000]
            n = len(some)
            yield rows(n, block=np.full(n, number), place=np.arange(at, at + n), pair=some, n=times[at : at + n])

    def align_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, number = aligner(left, right), TaskContext.get().partitionId() << 32
        keys, done, size = [], [], 0
        for whole in batches:
            for batch in by_bytes(whole, SLICE_BYTES):
                if size and size + batch.nbytes > BLOCK_BYTES:
                    yield from flushed(number, keys, done)
                    keys, done, size, number = [], [], 0, number + 1
                keys.append(batch.column(0))
                texts = batch.column(1).to_pylist()
                find.learn(texts)
                done += map(find, texts)
                size += batch.nbytes
        if keys:
            yield from flushed(number, keys, done)

    return docs.mapInArrow(align_, schema)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks one after another, each with its pairs before its documents: these get the sums over their links."""
    block, counts, best, table = None, [], [], None
    for batch in batches:
        blocks = batch["block"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if blocks[a] != block:
                block, counts, best, table = blocks[a], [], [], None
            part = batch.slice(a, b - a)
            of_pairs = part.num_rows - part["place"].null_count
            if of_pairs:
                counts.append(part["count"].slice(0, of_pairs).to_numpy())
                best.append(part["best"].slice(0, of_pairs).to_numpy(zero_copy_only=False))
            if of_pairs == part.num_rows:
                continue
            if table is None:
                none = [np.empty(0, np.int64)]
                table = np.concatenate(counts or none), np.concatenate(best or none).astype(np.int64)
            documents = part.slice(of_pairs)
            links = documents["links"]
            places, sizes = links.flatten().to_numpy(), documents["n_links"].to_numpy()
            ends = np.cumsum([0, *sizes])
            sums = [np.concatenate([[0], np.cumsum(t[places])])[ends] for t in table]
            names = [n for n in documents.schema.names if n not in ("block", "place", "count", "best", "links")]
            arrays = [documents[n] for n in names]
            for name, sum_ in zip(("count_sum", "n_best"), sums, strict=True):
                arrays.append(pa.array(np.diff(sum_), pa.int64()))
                names.append(name)
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def align(
    docs: DataFrame, left: str, right: str, key: str = "doc_id", text: str = "text", carry: dict[str, str] | None = None
) -> DataFrame:
    """One row per document: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``n_best``, ``count_sum``.

    ``left`` is a byte-level file of tokenizers (A), ``right`` a sentencepiece model (B). A link is a pair of tokens of both
    sides whose bytes overlap; the count of its ids is the number of links of all documents that have them. ``count_sum``
    adds the counts of a document's links, ``n_best`` tells how many have the highest count of their id of B. ``groups``
    has the ids between places where both sides end a token, as ``a1,a2|b1;a3|b2,b3``; ``carry`` may name columns and their
    SQL instead, so that nothing longer is stored.

    Texts are tokenised once. Links are counted by block before they are shuffled, and what is joined with the counts of
    the corpus are the distinct pairs of each block; a block's documents then add up what their links have there.

    A null or empty text, and one that either side's tokens do not decode to (with a blank before it), has no tokens:
    zeros and an empty ``groups``. Null keys are kept; repeated rows give a row each and count each; other columns are
    not read; no documents give no rows.
    """
    space = Workspace(docs.sparkSession, "alignment")
    source = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = _blocks(source, left, right)
    carry = carry or {"groups": "groups"}
    document = ["_key", "n_a", "n_b", "n_groups", "n_links", *carry]
    carried = [F.expr(sql).alias(name) for name, sql in carry.items()]
    kept = space.keep(rows.select("block", "place", "pair", "n", "links", *document[:5], *carried), "blocks")

    pairs = kept.filter("place IS NOT NULL")
    counts = space.keep(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "counts")
    ids_b = len(side(right).pieces)
    of_b = counts.select("pair", "count", (F.col("pair") % ids_b).alias("b"))
    # One row per id of B, of which there are as many as the model has.
    highest = F.broadcast(of_b.groupBy("b").agg(F.max("count").alias("highest")))
    judged = of_b.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    scored = pairs.select("block", "place", "pair").join(judged, "pair").select("block", "place", "count", "best")
    both = scored.unionByName(kept.filter("place IS NULL").select("block", "links", *document), allowMissingColumns=True)
    dealt = both.repartition("block").sortWithinPartitions("block", F.col("place").asc_nulls_last())
    schema = T.StructType([*(dealt.schema[n] for n in document), *T.StructType.fromDDL("count_sum bigint, n_best bigint").fields])
    return dealt.mapInArrow(_summed, schema).select(F.col("_key").alias(key), *document[1:], "n_best", "count_sum")
