"""Personal data: base patterns, and terms that give protected entities away.

Native: DataFrame and SQL functions only.

Base matches (e-mail, IP address, card, phone) come from patterns. Every match
value is a protected entity. Words near a match are terms; over the whole
corpus it is counted in how many documents a term stands near an entity,
n(e,t), and in how many it stands at all, n(t). A term discloses an entity when

* it stands near it in at least ``SUPPORT`` different contexts (copies of a
  passage are one context),
* knowing the term makes the entity likely: n(e,t) / n(t) >= ``LIKELY``,
* and that is news: log2(n(e,t) / n(t) * N / n(e)) >= ``BITS`` bits.

So the address that every licence line names is no secret that its neighbours
tell, and common words tell nothing. Disclosing terms are reported, beside the
entity, with kind ``term``. ``sanitise`` generalises matches and terms to a mark
of their kind, or removes them.

Positions come from the gaps between matches, in code points. The patterns are
written so that a match never rescans what came before: possessive repeats,
and a start only where a run begins or the last match ended. Counts are combined
in every task before a shuffle. Near an entity means within ``NEAR`` code points of
the text on either side, whatever else stands there: each word of the text that lies
in them as a whole is a term, also at their edges, which one more code point shows. So an entity in a third of all documents gives a bounded number of terms each.

NULL and empty texts have no matches. Repeated rows and NULL ids are rows of
their own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import written

KINDS = ("email", "ip", "card", "phone", "term")
# The contract's patterns; possessive repeats find the same without backtracking.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no match of the kind.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = r"[\p{L}\p{N}]{3,}+"
TERM_STARTS, TERM_ENDS = r"^[\p{L}\p{N}]", r"[\p{L}\p{N}]\z"
NEAR = 80
REACH = NEAR + 1  # with the code point beyond, which may go on with a word at the edge
PARTS_NEAR = REACH // 2 + 1  # a match has two code points or more
SUPPORT = 2
LIKELY = 0.5
BITS = 4.0
BROADCAST_TERMS = 50_000  # rows; a longer list is joined by a shuffle


def _luhn(digits: str) -> str:
    digit = f"int(substr({digits}, -i, 1))"
    doubled = f"{digit} * 2 - if({digit} > 4, 9, 0)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1, {digit}, {doubled})) % 10 = 0"


def _valid() -> Column:
    digits = "regexp_replace(hit, '[^0-9]', '')"
    return F.expr(
        f"""case kind when 'email' then true
        when 'ip' then hit rlike r'^{OCTET}(?:\\.{OCTET}){{3}}$'
        when 'card' then length({digits}) between 16 and 19 and {_luhn(digits)}
        else length({digits}) between 8 and 15 end"""
    )


PART = "struct<kind:string,i:int,gap:int,head:string,tail:string,hit:string>"


def _parts(kind: str) -> Column:
    """Gaps and matches in turn: a gap's length and ends, and the match after it (NULL after the last)."""
    text, pattern = F.col("text"), PATTERNS[kind]
    gaps = F.transform(
        F.split(text, pattern, -1),
        lambda gap: F.struct(F.length(gap).alias("n"), F.left(gap, F.lit(REACH)).alias("head"), F.right(gap, F.lit(REACH)).alias("tail")),
    )
    pairs = F.arrays_zip(gaps.alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    parts = F.transform(
        pairs,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), x["gaps"]["n"].alias("gap"), x["gaps"]["head"].alias("head"),
            x["gaps"]["tail"].alias("tail"), x["hits"].alias("hit"),
        ),
    )
    hint = text.rlike("[0-9]") if HINTS[kind] is None else text.contains(HINTS[kind])
    return F.when(hint, parts).otherwise(F.array().cast(f"array<{PART}>"))


def base_matches(rows: DataFrame) -> DataFrame:
    """Valid matches of ``rows`` (rid, parts): rid, kind, start, end, hit, before, after, runs_in, runs_out.

    The last two tell whether a word may run over the outer edge of ``before``
    or ``after``: a letter or digit stands beyond it.
    """
    parts = rows.filter("size(parts) > 0").select("rid", F.inline("parts"))
    turn = Window.partitionBy("rid", "kind").orderBy("i")
    so_far = F.sum(F.col("gap") + F.coalesce(F.length("hit"), F.lit(0))).over(turn.rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("end", so_far.cast("long")).withColumn("ok", F.col("hit").isNotNull() & F.coalesce(_valid(), F.lit(False)))
    some = F.max("ok").over(Window.partitionBy("rid", "kind"))  # texts with none need no surroundings
    placed = placed.withColumn("some", some).filter("some").withColumn("start", F.col("end") - F.length("hit"))
    # gaps and matches, valid or not, are the whole text: REACH code points on either side lie in the next few of them
    left_part = F.concat("tail", F.right(F.coalesce("hit", F.lit("")), F.lit(REACH)))
    right_part = F.concat("head", F.left(F.coalesce("hit", F.lit("")), F.lit(REACH)))
    ahead = F.array_join(F.collect_list(left_part).over(turn.rowsBetween(-PARTS_NEAR, -1)), "")
    behind = F.array_join(F.collect_list(right_part).over(turn.rowsBetween(1, PARTS_NEAR)), "")
    placed = placed.withColumn("left", F.right(F.concat(ahead, "tail"), F.lit(REACH))).withColumn("right", F.left(behind, F.lit(REACH)))
    before, after = F.right("left", F.lit(NEAR)).alias("before"), F.left("right", F.lit(NEAR)).alias("after")
    runs_in = ((F.length("left") > NEAR) & F.col("left").rlike(TERM_STARTS)).alias("runs_in")
    runs_out = ((F.length("right") > NEAR) & F.col("right").rlike(TERM_ENDS)).alias("runs_out")
    return placed.filter("ok").select("rid", "kind", "start", "end", "hit", before, after, runs_in, runs_out)


def context_terms(matches: DataFrame) -> DataFrame:
    """Words that stand whole in the surroundings of a match: rid, entity, context, term, start, end."""
    entity = F.concat("kind", F.lit(":"), F.lower("hit")).alias("entity")
    context = F.xxhash64("before", "after").alias("context")
    side = F.array(
        F.struct(
            F.col("before").alias("t"), (F.col("start") - F.length("before")).alias("at"),
            F.col("runs_in").alias("cut_first"), F.col("hit").rlike(TERM_STARTS).alias("cut_last"),
        ),
        F.struct(
            F.col("after").alias("t"), F.col("end").alias("at"),
            F.col("hit").rlike(TERM_ENDS).alias("cut_first"), F.col("runs_out").alias("cut_last"),
        ),
    )
    edges = ["cut_first", "cut_last"]
    sides = matches.select("rid", entity, context, "start", F.inline(side).alias("t", "at", *edges)).filter("t <> ''")
    # the same turn of gaps and words, in texts of at most NEAR code points
    words = F.arrays_zip(F.transform(F.split("t", TERM, -1), F.length).alias("gap"), F.regexp_extract_all("t", F.lit(TERM), F.lit(0)).alias("term"))
    parts = sides.select("rid", "entity", "context", "start", "at", *edges, F.length("t").alias("size"), F.posexplode(words).alias("i", "w"))
    turn = Window.partitionBy("rid", "entity", "start", "at").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    to = F.sum(F.col("w.gap") + F.coalesce(F.length("w.term"), F.lit(0))).over(turn)
    found = parts.select("rid", "entity", "context", "at", "size", *edges, F.col("w.term").alias("word"), to.alias("to")).filter("word is not null")
    found = found.withColumn("from", F.col("to") - F.length("word"))
    # a word at an edge of the surroundings is cut off there where letters go on
    whole = ~((F.col("from") == 0) & F.col("cut_first")) & ~((F.col("to") == F.col("size")) & F.col("cut_last"))
    return found.filter(whole).select(
        "rid", "entity", "context", F.lower("word").alias("term"), (F.col("at") + F.col("from")).alias("start"), (F.col("at") + F.col("to")).alias("end")
    )


def disclosing(near: DataFrame, matches: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term) pairs over the thresholds, with their counts and bits."""
    joint = near.groupBy("entity", "term").agg(F.count_distinct("rid").alias("n_et"), F.count_distinct("context").alias("contexts"))
    joint = written(joint.filter(F.col("contexts") >= SUPPORT), "pii-joint")
    terms = joint.select("term").distinct()
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    if terms.count() <= BROADCAST_TERMS:
        counts = words.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    else:
        counts = words.groupBy("term").agg(F.count("*").alias("n_t")).join(terms, "term", "left_semi")
    entity = F.concat("kind", F.lit(":"), F.lower("hit")).alias("entity")
    entities = matches.select(entity, "rid").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    total = docs.agg(F.count("*").alias("n")).first().n
    scored = joint.join(counts, "term").join(entities, "entity")
    scored = scored.withColumn("likely", F.col("n_et") / F.col("n_t"))
    scored = scored.withColumn("bits", F.log2(F.col("likely") * total / F.col("n_e")))
    return scored.filter((F.col("likely") >= LIKELY) & (F.col("bits") >= BITS))


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row: rid, doc_id and all spans (kind number, start, end), in order; ``text`` is not carried."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = F.concat(*[_parts(kind) for kind in PATTERNS])
    rows = texts.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.md5("text").alias("key"), parts.alias("parts"))
    rows = written(rows, "pii-parts")
    matches = written(base_matches(rows), "pii-matches")
    near = written(context_terms(matches), "pii-terms")
    pairs = disclosing(near, matches, texts).select("entity", "term")
    number = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])
    base = matches.select("rid", F.struct(number[F.col("kind")].alias("kind"), "start", "end").alias("span"))
    told = near.join(pairs, ["entity", "term"]).select("rid", F.struct(F.lit(len(PATTERNS)).alias("kind"), "start", "end").alias("span"))
    spans = base.union(told).groupBy("rid").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    term = len(PATTERNS)
    # a term inside a match, or touching one, is that match
    apart = f"""filter(spans, s -> s.kind < {term} or not exists(filter(spans, b -> b.kind < {term}),
        b -> s.start < b.end and b.start < s.end))"""
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    joined = rows.select("rid", "doc_id", "key").join(spans.withColumn("spans", F.expr(apart)), "rid", "left")
    return joined.select("rid", "doc_id", "key", F.coalesce("spans", none).alias("spans"))


def _listed(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"


def find_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts by kind, digest of the base spans, all spans as text, number of terms."""
    found = find_spans(docs)
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {i})) as bigint)").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    base = _listed(f"filter(spans, s -> s.kind < {len(PATTERNS)})")
    return found.select("doc_id", *counts, F.sha2(F.expr(base), 256).alias("base_sha256"), F.expr(_listed("spans")).alias("spans"))


def sanitise(docs: DataFrame, remove: bool = False) -> DataFrame:
    """``docs`` with matches and disclosing terms of ``text`` generalised to a mark, or removed.

    Rows and columns stay. Overlapping spans become the mark of the first.
    """
    found = find_spans(docs).filter("size(spans) > 0").groupBy("key").agg(F.first("spans").alias("spans"))
    by_place = "array_sort(transform(spans, s -> struct(s.start as start, s.end as end, s.kind as kind)))"
    marks = "array(" + ", ".join("''" if remove else f"'[{k.upper()}]'" for k in KINDS) + ")"
    rebuilt = F.expr(
        f"""aggregate({by_place}, struct('' as out, cast(0 as bigint) as at),
        (a, s) -> if(s.end <= a.at, a, struct(
            concat(a.out, if(s.start >= a.at, concat(substring(text, int(a.at) + 1, int(s.start - a.at)), {marks}[s.kind]), '')) as out,
            s.end as at)),
        a -> concat(a.out, substring(text, int(a.at) + 1)))"""
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", F.md5("text").alias("key"))
    joined = rows.join(found, "key", "left").withColumn("clean", F.when(F.col("spans").isNull(), F.col("text")).otherwise(rebuilt))
    return joined.select(*[(F.col("clean") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
