"""Surrogates keep form, identity and distinctness, and nothing personal is left."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

from yieldlens.llm import surrogates as sg

KEY = b"k"
TEXT = (
    "Call +1 (017) 555-7713 or (212) 555-0199, from 10.1.2.3 or 8.8.8.8. Mail Und.34@mail7.example.com, UND.34@MAIL7.EXAMPLE.COM. "
    "Mrs. Anna Smith met HERR and Herr Müller; card 4111 1111 1111 1111, 4111111111111111 and 9807915762804490; 123-45-6789."
)


def made(kind: str, written: str) -> str:
    return sg.dressed(written, kind, sg.surrogate(KEY, kind, sg.canonical(kind, written)))


def test_kinds_and_places():
    found = [(kind, TEXT[a:b]) for a, b, kind, _, _ in sg.mentions(TEXT)]
    assert found == [
        ("phone", "+1 (017) 555-7713"), ("phone", "(212) 555-0199"), ("ip", "10.1.2.3"), ("ip", "8.8.8.8"),
        ("email", "Und.34@mail7.example.com"), ("email", "UND.34@MAIL7.EXAMPLE.COM"), ("name", "Anna Smith"), ("name", "Müller"),
        ("account", "4111 1111 1111 1111"), ("account", "4111111111111111"), ("account", "9807915762804490"), ("number", "123-45-6789"),
    ]


def test_plain_text_is_left_alone():
    for text in ("In 2024, 3.5 of 12.000 items; v1.2.3; 10:30", "Mr. and mrs x", "a@b", "1-2-3", "1234567", ""):
        assert sg.mentions(text) == []


def test_form_is_kept():
    for a, b, kind, entity, written in sg.mentions(TEXT):
        new = made(kind, written)
        shape = lambda t: re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", t))
        if kind != "ip":
            assert shape(new) == shape(written)
        assert new != written and [(m[2], m[1] - m[0]) for m in sg.mentions(f"Frau {new}" if kind == "name" else new)] == [(kind, len(new))]
    assert made("phone", "+1 (017) 555-7713").startswith("+1 (")
    assert made("ip", "10.1.2.3").startswith("10.")
    assert made("name", "Anna Smith").split()[0].endswith("a") and made("name", "Müller")[0].isupper()
    assert made("email", "UND.34@MAIL7.EXAMPLE.COM") == made("email", "Und.34@mail7.example.com").upper()
    assert made("account", "4111 1111 1111 1111").replace(" ", "") == made("account", "4111111111111111")
    assert sg.luhn(made("account", "4111111111111111")) % 10 == 0 and sg.luhn(made("account", "9807915762804490")) % 10 != 0
    for name in ("Иван Петров", "Γιάννης"):
        assert all(ord(x) & ~63 == ord(y) & ~63 for x, y in zip(name, made("name", name), strict=True))


def test_documents(spark):
    texts = [TEXT, "again Und.34@mail7.example.com and 8.8.8.8", "nothing here", "", None, TEXT, "x" * 100_000 + " 8.8.4.4 " + "y" * 100_000]
    rows = [(i % 6, t, "a", "b", "c") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, blob string, entity string, _cuts string")
    out = sg.replaced(docs, KEY)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = sorted((r.doc_id, r.text or "") for r in out.collect())
    for (i, old), (j, new) in zip(sorted((i, t or "") for i, t, *_ in rows), got, strict=True):
        found = sg.mentions(old)
        assert i == j and bool(found) == (old != new) and not any(w in new for *_, w in found)
        for old_part, new_part in zip(re.split("\0", _without(old)), re.split("\0", _without(new)), strict=True):
            assert old_part == new_part
    assert [t for _, t in got if "again" in t][0].split()[1].rstrip(",") in [t for _, t in got if "Call" in t][0]
    assert sg.replaced(docs.limit(0), KEY).count() == 0
    assert sorted((r.doc_id, r.text or "") for r in sg.replaced(docs, b"other").collect()) != got


def _without(text: str) -> str:
    parts, at = [], 0
    for a, b, *_ in sg.mentions(text):
        parts.append(text[at:a])
        at = b
    return "\0".join([*parts, text[at:]])


def test_collisions_are_settled(spark, monkeypatch, tmp_path):
    """With hardly any surrogates to choose from, all entities get one of their own and none that is real."""
    narrow = lambda key, kind, entity, attempt=0: f"{(int(entity[1:]) * 7 + attempt * attempt) % 40 + 10:02d}"
    monkeypatch.setattr(sg, "surrogate", narrow)
    entities = [("number", f"n{i}") for i in range(25)] + [("number", "12"), ("phone", "p3")]
    monkeypatch.setattr(sg, "surrogate", lambda k, kind, e, a=0: narrow(k, kind, "n0" if e == "12" else e, a))
    table = spark.createDataFrame(entities, "kind string, entity string")
    got = sg.assigned(table, KEY, sg.Workspace(spark, "test")).collect()
    assert sorted((r.kind, r.entity) for r in got) == sorted(entities)
    by = defaultdict(set)
    for r in got:
        assert r.surrogate not in by[r.kind] and (r.kind, r.surrogate) not in entities
        by[r.kind].add(r.surrogate)
    monkeypatch.setattr(sg, "MOST_TRIES", 2)
    with pytest.raises(ValueError, match="more entities"):
        sg.assigned(table, KEY, sg.Workspace(spark, "test"))


def test_used_up_forms_grow(spark):
    """One letter, forms of which every surrogate is an entity, and a network without a free address."""
    short = [a + b for a in "bcdfghjklmnpqrstvwxyz" for b in "aeiou"]
    names = [*"abcdefghijklmnopqrstuvwxyz", *short]
    emails = [f"a@{a}.com" for a in short]
    phones = [f"+1{n:04d}" for n in range(10_000)]
    rows = [*(("name", n) for n in names), *(("email", e) for e in emails), *(("phone", p) for p in phones)]
    addresses = spark.range(254 * 254).selectExpr("'ip' AS kind", "concat('192.168.', 1 + id div 254, '.', 1 + id % 254) AS entity")
    entities = addresses.union(spark.createDataFrame(rows, "kind string, entity string"))
    got = sg.assigned(entities, KEY, sg.Workspace(spark, "test")).collect()
    real = {(r.kind, r.entity) for r in got}
    made = {(r.kind, r.surrogate) for r in got}
    assert len(got) == len(real) == len(made) == 254 * 254 + len(rows) and not real & made
    assert sg.dressed("BO", "name", "fato") == "FATO" and sg.dressed("Bo", "name", "fato") == "Fato"
    assert sg.dressed("+1 23-45", "phone", "+1678901") == "+1 67-8901"
    for name in ("X", "J", "Bo"):
        out = sg.replaced(spark.createDataFrame([(1, f"Mr {name} left")], "doc_id long, text string"), KEY).first().text
        assert out.startswith("Mr ") and out.endswith(" left") and f" {name} " not in out


def test_names_without_title(spark):
    """All forms of a name that a title gives away are found in its text, and keep what they share."""
    text = (
        "Mrs. Anna Smith met Mr John Paul Smith, Mr. J. P. Smith and Ms O'Brien. Anna Smith left. Later Smith's friend, J. Smith, "
        "SMITH and O’Brien said Mr. X. The smith from Smithfield paid Frau von Arnim-Berg; Arnim-Berg thanked Mr Smith. He left."
    )
    found = [text[a:b] for a, b, kind, _, _ in sg.mentions(text) if kind == "name"]
    assert found == ["Anna Smith", "John Paul Smith", "J. P. Smith", "O'Brien", "Anna", "Smith", "Smith", "J. Smith", "SMITH", "O’Brien", "X", "von Arnim-Berg",
                     "Arnim", "Berg", "Smith"]
    rows = [(1, text), (2, "Mr Smith alone"), (3, "The Smith of no title, Anna"), (4, "Mr Smith " * 3000)]
    out = {r.doc_id: r.text for r in sg.replaced(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    anna, john, paul = (sg.surrogate(KEY, "name", n).title() for n in ("anna", "john", "paul"))
    smith = out[2].split()[1]
    assert out[3] == rows[2][1] and out[4] == f"Mr {smith} " * 3000
    assert out[1].startswith(f"Mrs. {anna} {smith} met Mr {john} {paul} {smith}, Mr. {john[0]}. {paul[0]}. {smith} and Ms ")
    assert f". {anna} {smith} left. Later {smith}'s friend, {john[0]}. {smith}, {smith.upper()} and " in out[1]
    assert "The smith from Smithfield paid Frau von " in out[1] and out[1].endswith(f" thanked Mr {smith}. He left.")
    assert not re.search(r"Anna|Smith\b|SMITH|John|Paul|Brien|Arnim|Berg| X\.", out[1])
    kept = [tuple(sg.surrogate(KEY, "name", f"{c}. smith")) for c in "bcdfghjklmnpqrstvwxyz"]
    assert len(set(kept)) == 21
