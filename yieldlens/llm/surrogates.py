"""Personal data replaced by keyed surrogates of the same kind and form.

An entity gets the same surrogate wherever it stands and however it is written, different entities of a
kind get different ones, and no surrogate is an entity of the corpus. Without the key the surrogates tell
nothing but their form. What tells script, gender and format is kept: each letter gives way to one of its
alphabet, vowels to vowels, digits to digits; titles, endings of names, punctuation, country codes and check
digits stay.

A name is found behind a title, and from there its words in the rest of the text. The entity is the word: so a
surname has one surrogate with and without title and given names, and a surrogate's initial is that of the
given name's surrogate.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldlens.llm.splice import spliced
from yieldlens.llm.storage import Workspace
from yieldlens.llm.token_counts import by_bytes

# Titles before a name, by gender.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"), "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr")}

# Words between those of a name that are not changed.
PARTICLES = frozenset("af al bin da das de del della den der di do dos du el la le los ten ter van vom von zu zum zur".split())
# Capitalised words that begin a sentence rather than go on with a name.
STOPS = frozenset(
    """a an and as at but by for from he her his i if in is it its my no not now of on or our she so that the their then there
    these they this to we what when where who with you your aber als am auch auf aus bei das dass der die doch ein eine er es
    für ich ihr im in ist mit nach nun sie so und wenn wir zu avec ce cette dans elle en et il ils je mais nous on ou par pour
    que qui sur un une vous con cuando ella ellos en es este pero por que se si sin su un una yo""".split()
) | {t.lower() for ts in TITLES.values() for t in ts}

_TITLE = "|".join(t for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True))
# A word of a name, without what a genitive adds.
_NAME_WORD = re.compile(r"[^\W\d_]+(?:['\u2019](?![sS](?!\w))[^\W\d_]+)*")
_INITIALS = re.compile(r"(?:(?<!\w)[^\W\d_]\. ?)+$")
# Kinds in order of precedence where they overlap; the entity is the group, or the whole match without one.
KINDS = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")),
    ("account", re.compile(r"(?<![\w.])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])|(?<![0-9.])[0-9]{13,19}(?![0-9])")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9]|\.[0-9])")),
    (
        "phone",
        re.compile(
            r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,5}){2,5}(?![0-9])"
            r"|(?<![\w.])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])"
        ),
    ),
    ("number", re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    # From here on a name's words are read one by one.
    ("name", re.compile(rf"(?<!\w)(?:{_TITLE})\.? (?=[^\W\d_])")),
)
# Every match holds a digit or a title; texts without either are not looked at.
MAYBE = rf"[0-9@]|({_TITLE})\.? "

_MENTION = "blob string, start bigint, end bigint, kind string, entity string, written string"
# Proposals that keep the whole form, and then those that give up an ending or a network but not the length.
FORM_TRIES, WIDE_TRIES = 4, 2
# Every try after those adds a character, so no list of entities is long enough to get here.
MOST_TRIES = 50


def canonical(kind: str, written: str) -> str:
    """What all spellings of an entity share."""
    if kind in ("account", "phone", "number"):
        return "".join(c for c in written if c.isdigit() or c == "+")
    return written.lower().replace("\u2019", "'")


def mentions(text: str) -> list[tuple[int, int, str, str, str]]:
    """Start, end, kind, entity and spelling of the entities of a text, none overlapping another."""
    taken: list[tuple[int, int, str, str, str]] = []
    for kind, pattern in KINDS:
        if kind == "name":
            spans = [(m.end(), end) for m in pattern.finditer(text) if (end := _name_end(text, m.end())) > m.end()]
            taken = _added_spans(taken, kind, spans, text)
            known = {w for a, b, k, _, written in taken if k == "name" for w in _searched(written)}
            spans = _known_spans(text, known) if known else []
        else:
            spans = [m.span(m.lastindex or 0) for m in pattern.finditer(text)]
        taken = _added_spans(taken, kind, spans, text)
    return taken


def _added_spans(taken: list, kind: str, spans: list[tuple[int, int]], text: str) -> list:
    """The mentions and those of further spans, in order and apart, that overlap none of them."""
    starts, more, last = [m[0] for m in taken], [], 0
    for a, b in spans:
        i = bisect_left(starts, b)
        if a >= last and (i == 0 or taken[i - 1][1] <= a):
            more.append((a, b, kind, canonical(kind, text[a:b]), text[a:b]))
            last = b
    return sorted(taken + more)


def _name_end(text: str, at: int) -> int:
    """Where the run of capitalised words, initials and particles that begins here ends: at ``at`` if it is none."""
    end = start = at
    while m := _NAME_WORD.match(text, at):
        word, at = m[0], m.end()
        if text[at : at + 1] in ("_", *"0123456789"):
            break
        initial = len(word) == 1 and word.isupper()
        dotted = initial and text[at : at + 1] == "."
        if word[0].isupper():
            # An initial without a dot needs a name behind it.
            alone = initial and not dotted and not _goes_on(text, at)
            if end > start and word.lower() not in PARTICLES and not dotted and (alone or word.lower() in STOPS):
                break
            end = at
        elif word not in PARTICLES:
            break
        at += dotted
        if text[at : at + 1] in (" ", "-"):
            at += 1
        elif not dotted:
            break
    return end


def _goes_on(text: str, at: int) -> bool:
    m = _NAME_WORD.match(text, at + 1) if text[at : at + 1] == " " else None
    return bool(m and m[0][0].isupper() and m[0].lower() not in STOPS)


def name_words(written: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the words of a name that give way: ``initial`` for one letter beside longer words."""
    found = [m.span() for m in _NAME_WORD.finditer(written)]
    found = [s for s in found if written[slice(*s)].lower() not in PARTICLES] or found[-1:]
    longer = any(b - a > 1 for a, b in found)
    return [(a, b, "initial" if longer and b - a == 1 else "name") for a, b in found]


def _searched(written: str) -> Iterator[str]:
    """How the words of a name may be spelled where they stand without title."""
    for a, b, _ in name_words(written):
        word = written[a:b].replace("\u2019", "'")
        if b - a > 1 and word[0].isupper() and word.lower() not in STOPS and word.lower() not in PARTICLES:
            yield from (word, word.upper(), word[0] + word[1:].lower())


def _known_spans(text: str, known: set[str]) -> list[tuple[int, int]]:
    """Words known from a name, with the initials before them."""
    spans = []
    for m in _NAME_WORD.finditer(text):
        a, b = m.span()
        if m[0].replace("\u2019", "'") in known and not (text[a - 1 : a] + text[b : b + 1]).strip("'\u2019").replace("_", "0").isalnum():
            before = _INITIALS.search(text, max(0, a - 12), a)
            if before and before[0].replace(".", "").replace(" ", "").isupper():
                a = before.start()
            spans.append((a, b))
    return spans


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """The letters that may stand for this one: of its script's block, its case, and its kind of sound."""
    if c.isascii():
        group = next(g for g in ("aeiou", "bcdfghjklmnpqrstvwxyz", "0123456789") if c.lower() in g)
        return group if not c.isupper() else group.upper()
    first = ord(c) & ~63
    kind = unicodedata.category(c)
    same = lambda x: unicodedata.category(x) == kind and (x.lower() == x) == (c.lower() == c)
    # Changing its case there and back gives the letter again.
    return "".join(x for x in map(chr, range(first, first + 64)) if same(x) and x in (x.upper().lower(), x.lower().upper()))


def _stream(key: bytes, *about: str) -> Iterator[int]:
    """Numbers that only the key foretells."""
    block = 0
    while True:
        said = "\0".join((*about, str(block))).encode()
        yield from hmac.new(key, said, hashlib.sha256).digest()
        block += 1


def _number(stream: Iterator[int], below: int) -> int:
    """Evenly below a small limit."""
    while (x := next(stream)) >= 256 - 256 % below:
        pass
    return x % below


def _like(c: str, stream: Iterator[int]) -> str:
    if not c.isalnum():
        return c
    letters = _alphabet(c) or c
    return letters[_number(stream, min(len(letters), 256))]


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for numbers with a right check digit."""
    odd = [int(d) for d in digits[-1::-2]]
    return sum(odd) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])


@lru_cache(maxsize=4096)
def _initial(key: bytes, c: str) -> str:
    """Another letter of the same alphabet, and of no other letter."""
    order = sorted(_alphabet(c), key=lambda x: hmac.new(key, f"initial\0{x}".encode(), hashlib.sha256).digest())
    return order[(order.index(c) + 1) % len(order)] if c in order else c


def _word(key: bytes, word: str, attempt: int, wide: bool, more: int) -> str:
    """A word of a name with ``more`` letters added. Its last letter stays, as that often tells gender."""
    stream, first = _stream(key, "name", word, str(attempt)), _initial(key, word[0])
    if len(word) == 1:
        return first + _letters(stream, word, more)
    last = _like(word[-1], stream) if wide else word[-1]
    return first + "".join(_like(c, stream) for c in word[1:-1]) + _letters(stream, word, more) + last


def _letters(stream: Iterator[int], like: str, more: int) -> str:
    """So many letters of the alphabets of a text, if those have enough to choose from."""
    of = [c for c in like if c.isalpha() and len(_alphabet(c)) > 4] or ["a", "b"]
    return "".join(_like(of[i % len(of)], stream) for i in range(more))


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """A replacement for a canonical entity.

    The first attempts keep its form. There may be fewer surrogates of a form than entities, or none that is not an
    entity itself, so later ones choose from more and more: every one is longer by a character than that before.
    """
    stream = _stream(key, kind, entity, str(attempt))
    wide, more = attempt >= FORM_TRIES, max(0, attempt + 1 - FORM_TRIES - WIDE_TRIES)
    digits = lambda: "".join(_like("0", stream) for _ in range(more))
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        *hosts, _, top = domain.split(".")
        # A domain that nobody can own; the hosts before it keep their form.
        hosts = ["".join(_like(c, stream) for c in h) for h in hosts]
        made = "".join(_like(c, stream) for c in local) + _letters(stream, local, more)
        return made + "@" + ".".join([*hosts, "example", top if top in ("com", "net", "org") else "com"])
    if kind == "ip":
        first, second, *_ = octets = entity.split(".")
        kept = {"10": 1, "127": 1}.get(first, 2 if (first, second) in (("192", "168"), ("169", "254")) else 0)
        if wide and kept == 2:
            # The largest private network.
            octets, kept = ["10"], 1
        return ".".join([*octets[:kept], *(str(1 + _number(stream, 254)) for _ in range(4 - kept + more))])
    if kind == "account":
        made = entity[0] + "".join(_like(c, stream) for c in entity[1:-1]) + digits()
        valid = (10 - luhn(made + "0") % 10) % 10
        last = valid if luhn(entity) % 10 == 0 else (valid + 1 + _number(stream, 9)) % 10
        return f"{made}{last}"
    if kind == "phone":
        kept = 2 if entity.startswith("+") else 0
        return entity[:kept] + "".join(_like(c, stream) for c in entity[kept:]) + digits()
    if kind == "initial":
        return _initial(key, entity)
    if kind == "name":
        words, at = [], 0
        for a, b, part in name_words(entity):
            words += [entity[at:a], _initial(key, entity[a]) if part == "initial" else _word(key, entity[a:b], attempt, wide, more)]
            at = b
        return "".join([*words, entity[at:]])
    return "".join(_like(c, stream) for c in entity) + digits()


def dressed(written: str, kind: str, made: str) -> str:
    """The surrogate in the form in which its entity was written; what it is longer by comes last."""
    if kind in ("account", "phone", "number"):
        digits = iter(c for c in made if c.isdigit())
        return "".join(next(digits) if c.isdigit() else c for c in written) + "".join(digits)
    if kind == "name":
        rest = made[len(written) :]
        same = "".join(m.upper() if w.isupper() else m for w, m in zip(written, made, strict=False))
        return same + (rest.upper() if len(written) > 1 and written.isupper() else rest)
    return made.upper() if written.isupper() else made


def _parts(start: int, end: int, kind: str, entity: str, written: str) -> Iterator[tuple[int, int, str, str, str]]:
    """What of a mention is replaced by itself: the words of a name, else the whole."""
    if kind != "name":
        yield start, end, kind, entity, written
        return
    for a, b, part in name_words(written):
        yield start + a, start + b, part, canonical("name", written[a:b]), written[a:b]


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in by_bytes(whole):
            texts = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            rows = [(b, *part) for b, t in texts for m in mentions(t) for part in _parts(*m)]
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["blob", "start", "end", "kind", "entity", "written"])


def _added(table: DataFrame, column: str, make) -> DataFrame:
    """The table with a string column that ``make`` gives for each of its rows, as a dictionary."""
    names = [*table.columns, column]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([make(r) for r in batch.to_pylist()], pa.string())], names=names)

    return table.mapInArrow(add, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in table.schema)}, {column} string")


def assigned(entities: DataFrame, key: bytes, space: Workspace) -> DataFrame:
    """``kind``, ``entity`` and ``surrogate`` for a distinct list of entities.

    Every round proposes a surrogate to each entity still without one. A proposal that is itself an entity, or
    that was given before, is refused; of equal proposals the least entity's holds. Refused entities try
    again with the next number, until there are none: ``surrogate`` has more to choose from each time.
    """
    entities = space.keep(entities, "entities")
    real = entities.select("kind", F.col("entity").alias("surrogate"))
    pending, given = entities, None
    for attempt in range(MOST_TRIES):
        proposed = space.keep(
            _added(pending, "surrogate", lambda r, a=attempt: surrogate(key, r["kind"], r["entity"], a)), f"proposed-{attempt}"
        )
        taken = real if given is None else real.unionByName(given.select("kind", "surrogate"))
        first = proposed.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        held = space.keep(first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "entity", "surrogate"), f"given-{attempt}")
        given = held if given is None else given.unionByName(held)
        pending = space.keep(proposed.select("kind", "entity").join(held, ["kind", "entity"], "left_anti"), f"pending-{attempt}")
        if pending.isEmpty():
            return given
    raise ValueError("a kind has more entities than surrogates")


def replaced(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with personal data replaced by surrogates; all rows and columns stay.

    Only texts that can hold an entity are looked at and shuffled; mentions belong to contents, so copies
    count once and keys need not be distinct. Null and empty texts stay as they are.
    """
    space = Workspace(docs.sparkSession, "surrogates")
    blob, cuts = "_blob", "_cuts"
    while any(c in docs.columns for c in (blob, cuts)):
        blob, cuts = f"_{blob}", f"_{cuts}"
    body, maybe = F.col(text), F.coalesce(F.col(text).rlike(MAYBE), F.lit(False))
    addressed = docs.filter(maybe).withColumn(blob, F.sha2(body, 256))
    found = addressed.select(F.col(blob).alias("blob"), body.alias("text")).mapInArrow(_detect, _MENTION)
    found = space.keep(found.distinct(), "mentions")
    # An initial follows from its letter alone.
    initials, others = found.filter("kind = 'initial'"), found.filter("kind != 'initial'")
    given = assigned(others.select("kind", "entity").distinct(), key, space)
    put = _added(others.join(given, ["kind", "entity"]), "put", lambda r: dressed(r["written"], r["kind"], r["surrogate"]))
    more = _added(initials, "put", lambda r: dressed(r["written"], "name", surrogate(key, "initial", r["entity"])))
    put = put.select("blob", "start", "end", "put").unionByName(more.select("blob", "start", "end", "put"))
    by_text = put.groupBy(F.col("blob").alias(blob)).agg(F.array_sort(F.collect_list(F.struct("start", "end", "put"))).alias(cuts))
    changed = addressed.join(by_text, blob, "left").withColumn(text, spliced(body, F.col(cuts)))
    return changed.select(*docs.columns).unionByName(docs.filter(~maybe))
