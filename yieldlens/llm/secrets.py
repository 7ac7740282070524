"""Secret scans over content-addressed blobs, with a ledger of what was scanned under which rules."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldlens.llm.splice import spliced
from yieldlens.llm.storage import Workspace
from yieldlens.llm.token_counts import by_bytes

# To be raised whenever a rule changes: the ledger knows scans by it.
RULES_VERSION = 1


def _any_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# Kind, pattern, group whose length counts, least length. Matches are leftmost, longest and do not overlap
# within a kind; those too short are dropped afterwards. The first three kinds are the base.
_KEYWORDS = _any_case("password|passwd|secret|token|api_?key")
# A private key from its first line to the matching last one. Where that is missing or another key begins before it, to
# the end of the lines that are base64, or armour headers, whatever quotes them; and of long runs within a line.
_BREAK = r"(?:[\s\"'`>#*|,;+]|\\[nrt])"
_ARMOUR = r"(?:Proc-Type|DEK-Info|Version|Comment|Hash|MessageID|Charset|Subject|X-[A-Za-z-]+): ?(?:(?!\\[nr])[^\r\n])*+"
_ENDS = r"(?=[\s\"'`,;+\\]*(?:[\r\n]|\\[nr]|\Z)|[<\"'`])"
_BODY = rf"(?:{_BREAK}*+(?:{_ARMOUR}|[A-Za-z0-9+/]{{16,}}+={{0,2}}|[A-Za-z0-9+/]++={{1,2}}|=[A-Za-z0-9+/]{{4}}(?![A-Za-z0-9+/])|(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]++{_ENDS}))*+"
_PEM = (
    r"----(?:-| )BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)(?:-| )----"
    rf"(?:(?:(?!----[- ]BEGIN )[\s\S])*?----[- ]END \1[- ]----|{_BODY})"
)
RULES = (
    ("assign", re.compile(rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # A run that is too short can not match with its least length either, so that may stand in the pattern.
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
    ("pem", re.compile(_PEM), 0, 0),
    # What no dot follows matches, too, and is dropped: so no run is searched again from each of its places.
    ("web", re.compile(r"eyJ[A-Za-z0-9_-]{8,}+(\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+)?"), 1, 1),
)
BASE = tuple(kind for kind, *_ in RULES[:3])
# The ledger knows scans by the patterns, too: what other patterns found is scanned again.
PATTERNS = hashlib.sha256(repr([(kind, p.pattern, group, least) for kind, p, group, least in RULES]).encode()).hexdigest()[:16]
# Blobs with findings are told from others by a slot of their hash before they are joined: a few MB if all are taken.
SLOTS = 1 << 20

_FINDINGS = "blob string, findings array<struct<kind:string,start:bigint,end:bigint>>"


def findings(text: str) -> list[dict]:
    """All spans of the rules in code points, by start, then by kind as listed."""
    found = [
        (m.start(), order, m.end(), kind)
        for order, (kind, pattern, group, least) in enumerate(RULES)
        for m in pattern.finditer(text)
        if m.end(group) - m.start(group) >= least
    ]
    return [{"kind": kind, "start": start, "end": end} for start, _, end, kind in sorted(found)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for whole in batches:
        for batch in by_bytes(whole):
            spans = [findings(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["blob", "findings"])


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _slot(blob: Column) -> Column:
    return F.pmod(F.xxhash64(blob), F.lit(SLOTS)).cast("int")


def scan(versions: DataFrame, ledger: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Findings of every version: ``key``, ``blob`` and ``findings`` (kind, start, end in code points).

    Equal contents are one blob, whichever version or path they come from. Only blobs that the ledger does
    not hold under the present rules are scanned; what was found, nothing included, is appended to it, and
    then joined back to all versions. The ledger is a Parquet folder by patterns and rules version; without one, a
    folder of this application's own is taken. Contents are combined before they are shuffled, so a
    blob with very many versions moves once per task at most.

    A null text is the empty blob; a null key is kept; repeated rows give a row each; other columns are not
    read; no versions give no rows.
    """
    spark = versions.sparkSession
    ledger = ledger or f"{Workspace(spark, 'ledger').path}/ledger"
    current = f"{ledger}/patterns=p{PATTERNS}/rules={RULES_VERSION}"
    addressed = versions.select(key, F.coalesce(text, F.lit("")).alias("_text")).withColumn("blob", blob_id(F.col("_text")))
    blobs = addressed.groupBy("blob").agg(F.first("_text").alias("text"))
    seen = _ledger(spark, current)
    unseen = blobs if seen is None else blobs.join(seen.select("blob"), "blob", "left_anti")
    unseen.select("blob", "text").mapInArrow(_scan, _FINDINGS).write.mode("append").parquet(current)
    # Almost all blobs have no findings: only the others need to meet their versions.
    hits = spark.read.schema(_FINDINGS).parquet(current).filter(F.size("findings") > 0)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return addressed.drop("_text").join(hits, "blob", "left").select(key, "blob", F.coalesce("findings", none).alias("findings"))


def _ledger(spark, folder: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_FINDINGS).parquet(folder)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of the findings of ``scan``."""
    base = F.filter("findings", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("findings", lambda s: s["kind"])
    # Without a kind, the array is shorter by as many as there were.
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return scanned.select(
        key, *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("findings")).alias("spans")
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every stretch of findings replaced by ``mark``; all rows and columns stay.

    Findings belong to contents, so they are joined by content: keys need not be distinct. Only texts whose content may
    have findings, by a slot of its hash, are moved for that join.
    """
    blob, spans, slot = "_blob", "_spans", "_slot"
    while any(c in docs.columns for c in (blob, spans, slot)):
        blob, spans, slot = f"_{blob}", f"_{spans}", f"_{slot}"
    scanned = scan(docs, key=key, text=text).filter(F.size("findings") > 0)
    found = scanned.groupBy("blob").agg(F.first("findings").alias("findings"))
    found = Workspace(docs.sparkSession, "secrets").keep(found, "found")
    # At most SLOTS rows, whatever the corpus; a text whose slot is not among them has no findings and stays where it is.
    slots = F.broadcast(found.select(_slot(F.col("blob")).alias(slot)).distinct())
    marked = docs.withColumn(blob, blob_id(F.col(text))).withColumn(slot, _slot(F.col(blob)))
    cuts = F.transform(stretches(F.col("findings")), lambda s: F.struct(s["start"], s["end"], F.lit(mark).alias("put")))
    likely = marked.join(slots, slot, "left_semi").join(found.select(F.col("blob").alias(blob), cuts.alias(spans)), blob, "left")
    cut = likely.withColumn(text, spliced(F.col(text), F.col(spans))).select(*docs.columns)
    return marked.join(slots, slot, "left_anti").select(*docs.columns).unionByName(cut)


def stretches(spans: Column) -> Column:
    """Spans, sorted by start, with those that overlap or touch made one."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        span = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(
            F.coalesce(last["end"] >= s["start"], F.lit(False)),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, add)
