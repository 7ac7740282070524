"""Quality rules: repetition and length, then divergence from what a language usually looks like."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldlens.llm.storage import Workspace

# White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = r"[\x20\x09-\x0D]"
# Character classes of the histogram in order; what none of them takes is the last bin.
CLASSES = (r"[a-z]+", r"[A-Z]+", r"[0-9]+", r"[#*$%&|<>]+", r"[!-/:-@\[-`{-~]+")
SYMBOLS = 3

# Frequent words by language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "für"),
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "on", "was"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
}

SPELLINGS = sorted({s for words in COMMON_WORDS.values() for word in words for s in (word, word.title())})


@dataclass(frozen=True)
class Rules:
    """Limits. A distance is judged only on documents that hold enough to tell."""

    least_words: int = 50
    most_repeated: int = 50  # per cent of the words
    least_chars_for_classes: int = 200
    class_limit: tuple[float, float] = (0.22, 1.0)
    least_words_for_common: int = 50
    common_limit: tuple[float, float] = (0.13, 1.3)
    # A language with fewer documents that pass the base rules has no reference of its own.
    least_documents: int = 10


def _get(array: Column, index: Column) -> Column:
    return F.get(array, index)


def features(docs: DataFrame, name: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """Add the column ``name``: a struct of counts over the whole text. All else stays as it is.

    Steps are columns of their own so that Spark computes each once. Windows of three words are told
    apart by a 64-bit hash within their document.
    """
    step = [f"{name}_{i}" for i in range(7)]
    words, joined, rest, grams, places, hits, lines = step
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn(words, F.filter(F.split(body, _SPACE + "+"), lambda w: w != ""))
    out = out.withColumns(
        {
            joined: F.array_join(words, ""),
            lines: F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            hits: F.transform(
                F.filter(words, lambda w: w.isin(SPELLINGS)),
                F.lower,
            ),
            grams: F.when(
                F.size(words) >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - 3),
                    lambda i: F.struct(F.xxhash64(*[_get(F.col(words), i + k) for k in range(3)]).alias("h"), i.alias("i")),
                ),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
        }
    )
    # What is left of the characters after each class is taken out; the first pass leaves little for the others.
    out = out.withColumn(rest, F.array(F.col(joined)))
    for pattern in CLASSES:
        out = out.withColumn(rest, F.concat(F.array(F.regexp_replace(_get(F.col(rest), F.lit(0)), pattern, "")), F.col(rest)))
    left = [F.length(_get(F.col(rest), F.lit(len(CLASSES) - i))) for i in range(len(CLASSES) + 1)]
    classes = F.array(*[a - b for a, b in zip(left, left[1:], strict=False)], left[-1])
    # Sorting is needed only where a window comes twice.
    twice = F.size(F.array_distinct(F.transform(grams, lambda g: g["h"]))) < F.size(grams)
    out = out.withColumn(places, F.when(twice, F.sort_array(grams)))
    repeated = F.filter(
        places,
        lambda g, i: (_get(F.col(places), i - 1)["h"] == g["h"]) | (_get(F.col(places), i + 1)["h"] == g["h"]),
    )
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda g: F.array(g["i"], g["i"] + 1, g["i"] + 2))))
    lists = F.create_map(*[c for k, v in COMMON_WORDS.items() for c in (F.lit(k), F.array(*map(F.lit, v)))])
    common = F.transform(F.try_element_at(lists, F.col(lang)), lambda c: F.size(F.filter(hits, lambda w: w == c)))
    return out.withColumn(
        name,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            classes[SYMBOLS].cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("long").alias("n_dup_lines"),
            F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
            classes.alias("classes"),
            common.alias("common"),
        ),
    ).drop(*step)


def _sums(column: Column, size: int) -> list[Column]:
    return [F.sum(_get(column, F.lit(i)).cast("long")).alias(f"c{i}") for i in range(size)]


def _shares(counts: Column, total: Column) -> Column:
    """Counts as shares, and what is left of the total as the last bin."""
    known = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
    return F.transform(F.concat(counts.cast("array<long>"), F.array(total - known)), lambda c: F.try_divide(c, total))


def _any_script(classes: Column) -> list[Column]:
    """Letters with all that is not ASCII, digits, symbols, other punctuation."""
    small, large, digits, symbols, marks, others = (_get(classes, F.lit(i)) for i in range(len(CLASSES) + 1))
    return [small + large + others, digits, symbols, marks]


def jensen_shannon(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares: 0 if equal, 1 if nothing is shared."""
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    both = F.zip_with(left, right, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2))


def judged(docs: DataFrame, name: str, rules: Rules, lang: str = "lang") -> DataFrame:
    """Add ``base_failed``, ``class_distance``, ``common_distance`` and ``kept`` to ``features``' struct.

    The references of a language are the summed histograms of all its documents that pass the base rules. Of fewer
    than ``least_documents`` one could set the measure for the others, so those are held against all languages
    together, by what every script has: letters (any that are not ASCII among them), digits, symbols, punctuation. A
    distance is null, and not held against a document, where the document is too short, its language is null, or,
    for words, none are listed for it or it has no reference. ``docs`` is used twice and should be stored.
    """
    f = F.col(name)
    failed = (f["n_words"] < rules.least_words) | (100 * f["n_repeat_words"] > rules.most_repeated * f["n_words"])
    n_classes, n_words = len(CLASSES) + 1, len(COMMON_WORDS["en"])
    passed = docs.filter(~failed & F.col(lang).isNotNull())
    sums = passed.groupBy(F.col(lang).alias("_lang")).agg(
        F.count("*").alias("documents"),
        F.sum(f["word_chars"]).alias("chars"),
        F.sum(f["n_words"]).alias("words"),
        F.array(*_sums(f["classes"], n_classes)).alias("classes"),
        F.array(*_sums(f["common"], n_words)).alias("common"),
    )
    sums = Workspace(docs.sparkSession, "references").keep(sums, "sums")
    every = [F.sum(c) for c in _any_script(F.col("classes"))]
    # Four numbers.
    pooled = F.array(*[F.lit(share).cast("double") for share in sums.agg(*[F.try_divide(c, F.sum("chars")) for c in every]).first()])
    references = sums.select(
        "_lang",
        (F.col("documents") >= rules.least_documents).alias("_enough"),
        _shares(F.col("classes"), F.col("chars")).alias("_classes"),
        F.when(_get(F.col("common"), F.lit(0)).isNotNull(), _shares(F.col("common"), F.col("words"))).alias("_common"),
    )
    out = docs.join(references, docs[lang] == F.col("_lang"), "left")
    shares = _shares(f["classes"], f["word_chars"])
    to_own, to_all = jensen_shannon(shares, F.col("_classes")), jensen_shannon(F.array(*_any_script(shares)), pooled)
    of_classes = F.when(f["word_chars"] >= rules.least_chars_for_classes, F.when(F.col("_enough"), to_own).when(~F.col("_enough"), to_all))
    of_words = F.when(
        F.col("_enough") & (f["n_words"] >= rules.least_words_for_common),
        jensen_shannon(_shares(f["common"], f["n_words"]), F.col("_common")),
    )
    chance = F.try_divide(F.lit(1.0), F.sqrt(f["n_words"].cast("double")))
    verdict = (
        ~failed
        & F.coalesce(of_classes <= rules.class_limit[0] + rules.class_limit[1] * chance, F.lit(True))
        & F.coalesce(of_words <= rules.common_limit[0] + rules.common_limit[1] * chance, F.lit(True))
    )
    added = {"base_failed": failed, "class_distance": of_classes, "common_distance": of_words, "kept": verdict}
    return out.withColumn(name, F.struct(F.col(f"{name}.*"), *[c.alias(n) for n, c in added.items()])).drop(
        "_lang", "_enough", "_classes", "_common"
    )


def quality_verdicts(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``key``, the counts, both distances, ``base_failed`` and ``kept``.

    Texts are read once: the counts are stored, then set against the references that they give. A null or
    empty text has no words and fails the base rules; a null key is kept; repeated rows give a row each;
    other columns are not read; no documents give no rows.
    """
    counted = features(docs.select(key, F.col(text).alias("_text"), F.col(lang).alias("_of")), "_q", "_text", "_of")
    stored = Workspace(docs.sparkSession, "quality").keep(counted.drop("_text"), "counts")
    return judged(stored, "_q", rules, "_of").select(key, "_q.*").drop("classes", "common")


def good_documents(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that ``quality_verdicts`` would keep, with all their columns and nothing else."""
    name = "_quality"
    while any(c.startswith(name) for c in docs.columns):
        name = f"_{name}"
    stored = Workspace(docs.sparkSession, "quality").keep(features(docs, name, text, lang), "counted")
    return judged(stored, name, rules, lang).filter(F.col(name)["kept"]).select(*docs.columns)
