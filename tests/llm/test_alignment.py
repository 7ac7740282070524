"""Tokens of two libraries side by side, against plain loops over what the libraries give."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from yieldlens.llm import alignment

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
ATOMS = [
    *("foo", "Bar", "über", "日本語", "🙂", " ", "  ", "\n", "\n\n", "\t", ",", ".", "'s", "don't", "▁", "</s>", "<|endoftext|>", "<0x41>"),
    *("é", "\xa0", "1234", "!?", "_", "x" * 70, "𐍈", "\x00", "-", "Ωm", "ªb", "é", "Ġ", "<unk>"),
]


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(public_tokenizers.path(LEFT))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(RIGHT))
    spelled = {v: k for k, v in alignment.vocabulary._byte_letters().items()}

    def tokens(text):
        """Ids and bytes of both sides, or None."""
        a = left.encode(" " + text, add_special_tokens=False).ids
        b = right.encode(text)
        a = [(i, bytes(spelled[c] for c in left.id_to_token(i))) for i in a]
        names = [(i, right.id_to_piece(i)) for i in b]
        b = [(i, bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode()) for i, n in names]
        whole = (" " + text).encode()
        return (a, b) if text and all(b"".join(p for _, p in side) == whole for side in (a, b)) else None

    return tokens


def spans(tokens):
    at, out = 0, []
    for id_, piece in tokens:
        out.append((id_, at, at + len(piece)))
        at += len(piece)
    return out


def compared(a, b):
    """Groups as text, and all links, by comparing every token with every other."""
    a, b = spans(a), spans(b)
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    sides = [[[] for _ in cuts] for _ in (a, b)]
    for side, into in zip((a, b), sides, strict=True):
        at = 0
        for id_, start, _ in side:
            while start >= cuts[at]:
                at += 1
            into[at].append(str(id_))
    groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
    # Only tokens nearby can overlap.
    links, first = [], 0
    for i, s, e in a:
        while first < len(b) and b[first][2] <= s:
            first += 1
        j = first
        while j < len(b) and b[j][1] < e:
            links.append((i, b[j][0]))
            j += 1
    return groups, links


def test_texts_made_of_awkward_parts(libraries):
    find, draw = alignment.aligner(LEFT, RIGHT), random.Random(5)
    assert find.splits and find.parts
    made = ["".join(draw.choice(ATOMS) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    find.learn(made[::2])
    none = 0
    for text in made:
        wanted, found = libraries(text), find(text)
        if wanted is None:
            assert found is None, text
            none += 1
            continue
        groups, links = compared(*wanted)
        assert found[:4] == (len(wanted[0]), len(wanted[1]), len(groups), ";".join(groups)), text
        packed = alignment.np.frombuffer(found.links, alignment.np.int64).tolist()
        assert [divmod(x, find.ids_b) for x in packed] == links, text
    assert 0 < none < len(made) / 2


def test_windows_of_long_texts(libraries, monkeypatch):
    monkeypatch.setattr(alignment.windows, "__defaults__", (100,))
    text = "alpha beta, gamma\ndelta  epsilon 123 " * 40 + "über" * 100
    groups, _ = compared(*libraries(text))
    assert alignment.Aligner(LEFT, RIGHT)(text).groups == ";".join(groups)


def test_little_is_remembered(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 64)
    find = alignment.Aligner(LEFT, RIGHT)
    for i in range(20):
        text = " ".join(f"word{chr(97 + i)}{chr(97 + k)}, x" for k in range(26))
        groups, _ = compared(*libraries(text))
        find.learn([text])
        assert find(text).groups == ";".join(groups)
        assert len(find.words) + len(find.words.older) <= 64


def test_cuts_that_do_not_fit_are_refined():
    # Three tokens share one character of three bytes; its span ends behind all of them.
    assert alignment.refined([1, 4, 4, 4], [b"a", b"\xe6", b"\x97", b"\xa5"], "a日".encode()) == [1, 2, 3, 4]
    assert alignment.refined([1, 2], [b"a", b"x"], b"ab") is None
    assert alignment.refined([9, 9], [b"a", b"b"], b"ab") == [1, 2]
    assert alignment.refined([1], [b"a"], b"ab") is None


def _brute(rows, libraries):
    done, counts = [], Counter()
    for key, text in rows:
        tokens = libraries(text or "")
        groups, links = compared(*tokens) if tokens else ([], [])
        counts.update(links)
        done.append((key, tokens or ((), ()), groups, links))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(
        (
            key if key is not None else -1,
            len(tokens[0]),
            len(tokens[1]),
            len(groups),
            len(links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(counts[x] == highest[x[1]] for x in links),
            sum(counts[x] for x in links),
        )
        for key, tokens, groups, links in done
    )


@pytest.mark.parametrize("block", [4 << 20, 3000])
def test_whole_documents(spark, documents, libraries, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    # Names that the operator uses itself must not get in its way.
    docs = documents.withColumn("block", F.lit(1)).withColumn("groups", F.lit("x")).withColumn("links", F.lit(2))
    carry = {"sha": "if(groups = '', '', sha2(groups, 256))"}
    found = alignment.align(docs, LEFT, RIGHT, carry=carry)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_best", "count_sum"]
    mine = sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())
    assert mine == _brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], libraries)


def test_spans_are_given(spark, libraries):
    docs = spark.createDataFrame([(1, "Hello über 日本"), (2, None), (3, "a▁b")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in alignment.token_spans(docs, LEFT, RIGHT).collect()}
    a, b = libraries("Hello über 日本")
    assert [(x.id, x.end) for x in rows[1].a] == [(i, e) for i, _, e in spans(a)]
    assert [(x.id, x.end) for x in rows[1].b] == [(i, e) for i, _, e in spans(b)]
    assert rows[2].a == rows[2].b == rows[3].a == rows[3].b == []


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(empty, LEFT, RIGHT).collect() == []


def test_words_of_the_older_generation_are_not_asked_for_again(monkeypatch):
    words = ["".join(random.Random(i).choices("abcdefgh", k=9)) for i in range(115)]
    find = alignment.Aligner(LEFT, RIGHT)
    find.words.size = 60
    find.learn([" ".join(words[:50])])
    find.learn([" ".join(words[50:80])])
    text = " ".join(words[:20] + words[80:])
    wanted = alignment.Aligner(LEFT, RIGHT)(text)
    find.learn([text])
    monkeypatch.setattr(find, "_whole", None)
    assert find(text) == wanted


def test_no_spans_are_asked_for_where_the_tokens_decode_to_the_text(monkeypatch):
    text = "plain words, é naïve\nlines\n\nand more 日本"
    parts, find = [" " + w for w in text.split(" ")], alignment.Aligner(LEFT, RIGHT)
    wanted = find._whole(parts, False)
    for side in (find.a, find.b):
        monkeypatch.setattr(side, "coarse", None)
    assert find._plain(parts, False) == wanted
