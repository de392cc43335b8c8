"""Secret scan: base patterns, and weak candidates linked by what stands near them.

Some strings are secrets by their shape (``assign``, ``access``, ``hex``).
Others are weak: a short password, a bare key-like string, a user name or an
endpoint mean little alone. They are reported as ``weak_secret``, ``weak_id``
and ``endpoint`` only when the complementary part stands in the same scope:

* a secret needs an identifier or an endpoint,
* an identifier needs a secret,
* an endpoint needs an identifier and a secret.

A scope is a paragraph (text between blank lines). Parts are linked by an
interval join: two parts of one scope that are at most ``reach`` code points
apart. The join runs on bins of ``reach`` code points: every bin that the one part
touches and every bin that the other touches when widened by the reach, so two
parts within reach share a bin and a part meets only its neighbours, however
long the text.

NULL and empty texts have no parts. Every row is scanned by itself: repeated
rows and repeated ids give as many result rows. A NULL ``doc_id`` stays NULL.
Other columns of the input are dropped and cannot clash.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import map_texts, written

# The kinds and patterns of the scan's contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

IDENTIFIER = re.compile(
    r"""\b(?:user(?:name|_id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{3,})""",
    re.ASCII | re.IGNORECASE,
)
WEAK_SECRET = re.compile(
    r"""\b(?:pass|pwd|pw|passphrase|credential|auth)["']?\x20*[:=]\x20*["']?([^\s"',;]{4,})""",
    re.ASCII | re.IGNORECASE,
)
BARE_KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(
    r"\b(?:[a-z][a-z0-9+.-]{1,9}://[A-Za-z0-9.-]+(?::\d+)?|(?:host|endpoint|server)\x20*[:=]\x20*[A-Za-z0-9.-]{3,})",
    re.ASCII,
)
# Without one of these no pattern but the runs of characters can match.
HINT = re.compile(r"[:=]")
SCOPE_END = re.compile(r"\n[ \t]*\n")

ROLE = {
    "assign": "secret", "hex": "secret", "weak_secret": "secret",
    "access": "id", "weak_id": "id", "endpoint": "endpoint",
}
REACH = 300
SCAN = (
    "doc_id long, key string, base array<struct<kind:string,start:long,end:long>>, "
    "weak array<struct<kind:string,start:long,end:long,scope:long>>"
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches, by start, then kind."""
    found = []
    if HINT.search(text):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def weak_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates that count only beside a complementary part."""
    found = [("weak_secret", *m.span()) for m in BARE_KEY.finditer(text) if _mixed(m[0])]
    if HINT.search(text):
        found += [("weak_id", *m.span()) for m in IDENTIFIER.finditer(text)]
        found += [("weak_secret", *m.span()) for m in WEAK_SECRET.finditer(text)]
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    return found


def _mixed(word: str) -> bool:
    return bool(re.search("[0-9]", word) and re.search("[A-Z]", word) and re.search("[a-z]", word))


def _scan(batch: pa.RecordBatch) -> dict:
    base, weak, keys = [], [], []
    for text in batch.column("text").to_pylist():
        text = text or ""
        strong, found = base_spans(text), weak_spans(text)
        keys.append(hashlib.md5(text.encode()).hexdigest() if found else None)
        base.append([dict(zip(("kind", "start", "end"), x)) for x in strong])
        parts = []
        if found:  # the strong parts are wanted as partners only
            ends = [m.start() for m in SCOPE_END.finditer(text)]
            parts = _with_scopes(sorted({*strong, *found}, key=lambda x: x[1:]), ends)
        weak.append(parts)
    span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    return {
        "doc_id": batch.column("doc_id"),
        "key": pa.array(keys, pa.string()),
        "base": pa.array(base, pa.list_(pa.struct(span))),
        "weak": pa.array(weak, pa.list_(pa.struct([*span, ("scope", pa.int64())]))),
    }


def _with_scopes(spans, ends: list[int]) -> list[dict]:
    parts, scope = [], 0
    for kind, start, end in spans:
        while scope < len(ends) and ends[scope] < start:
            scope += 1
        parts.append({"kind": kind, "start": start, "end": end, "scope": scope})
    return parts


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts that have their complement: (key, kind, start, end).

    ``parts`` has (key, scope, kind, start, end), every part once.
    """
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
    parts = parts.withColumn("role", role[F.col("kind")])
    own_bins = F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor(F.col("end") / reach)))
    near = parts.select(
        "key", "scope", F.col("role").alias("other"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
        # every bin that the interval, widened by the reach, touches
        F.explode(F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach))).alias("bin"),
    )
    weak = parts.filter(F.col("kind").isin("weak_secret", "weak_id", "endpoint"))
    # a pair that meets in several bins is one for the aggregate below
    pairs = weak.withColumn("bin", own_bins).join(near, ["key", "scope", "bin"]).filter(
        (F.col("role") != F.col("other"))
        & (F.col("o_start") - F.col("end") <= reach)
        & (F.col("start") - F.col("o_end") <= reach)
        # an identifier inside a secret's own span is that secret
        & ~((F.col("o_start") <= F.col("start")) & (F.col("end") <= F.col("o_end")))
    )
    has = {r: F.max(F.when(F.col("other") == r, 1).otherwise(0)) for r in ("secret", "id", "endpoint")}
    seen = pairs.groupBy("key", "kind", "start", "end", "role").agg(*[c.alias(f"has_{r}") for r, c in has.items()])
    return seen.filter(
        F.expr(
            "case role when 'secret' then has_id + has_endpoint > 0 when 'id' then has_secret > 0"
            " else has_secret = 1 and has_id = 1 end"
        )
    ).select("key", "kind", "start", "end")


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``base`` and ``linked`` spans, (kind, start, end).

    ``base`` is in order of start, then kind; ``linked`` likewise.
    """
    found = written(map_texts(docs.select("doc_id", "text"), _scan, SCAN), "secret-parts")
    # Rows of one text have the same parts: one of them is enough for the join.
    texts = found.filter("key is not null").groupBy("key").agg(F.min("weak").alias("weak"))
    parts = texts.select("key", F.inline("weak"))
    linked = linked_parts(parts, reach).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("l")
    )
    linked = linked.select("key", F.expr("transform(l, x -> struct(x.kind, x.start, x.end))").alias("linked"))
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")
    # most rows have no weak part, so no key: they take no part in the join
    with_parts = found.filter("key is not null").join(linked, "key", "left")
    return with_parts.select("doc_id", "base", F.coalesce("linked", none).alias("linked")).union(
        found.filter("key is null").select("doc_id", "base", none.alias("linked"))
    )


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def scan_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the base spans, and all spans as text."""
    spans = scan_secrets(docs)
    order = (
        "array_sort(concat(base, linked), (a, b) -> case when a.start < b.start then -1 when a.start > b.start then 1"
        " when array_position(array('assign','access','hex','weak_id','weak_secret','endpoint'), a.kind)"
        " < array_position(array('assign','access','hex','weak_id','weak_secret','endpoint'), b.kind) then -1 else 1 end)"
    )
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"),
        F.expr(_joined(order)).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )


MASK = "[SECRET]"


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with every span, overlapping ones together, replaced by a mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], MASK]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span of ``text`` masked; rows and columns stay.

    Spans are joined back by the text's digest, so repeated ids do no harm.
    """
    narrow = docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    found = written(map_texts(narrow, _scan_keyed, SCAN).filter("size(base) + size(weak) > 0"), "secret-parts")
    texts = found.groupBy("key").agg(F.min("base").alias("base"), F.min("weak").alias("weak"))
    linked = linked_parts(texts.select("key", F.inline("weak")))
    spans = texts.select("key", F.inline("base")).union(linked).groupBy("key").agg(
        F.flatten(F.sort_array(F.collect_list(F.array("start", "end")))).alias("spans")
    )
    # a NULL text has no key and no span: it stays out of the join
    rows = docs.filter("text is not null").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.md5("text").alias("key"))
    masked_text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(_mask("row.text", "spans"))
    clean = rows.join(spans, "key", "left").select(
        *[(masked_text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    )
    return clean.union(docs.filter("text is null"))


def _scan_keyed(batch: pa.RecordBatch) -> dict:
    texts = batch.column("text").to_pylist()
    keys = [None if t is None else hashlib.md5(t.encode()).hexdigest() for t in texts]
    return _scan(batch) | {"key": pa.array(keys, pa.string())}


@F.pandas_udf(T.StringType())
def _mask(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series(
        [t if s is None else masked(t, list(zip(s[::2], s[1::2]))) for t, s in zip(text, spans)], dtype=object
    )
