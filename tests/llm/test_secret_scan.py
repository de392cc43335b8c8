import hashlib
import random
import re

from conftest import SF_DIR
from pyspark.sql import functions as F

from weir.llm import secret_scan as S
from weir.llm.queries import REGISTRY
from weir.queries.tables import table

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    text = text or ""
    found = [("assign", *m.span()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) > 7]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) > 15]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) > 31]
    order = {"assign": 0, "access": 1, "hex": 2}
    found.sort(key=lambda s: (s[1], order[s[0]]))
    counts = [sum(k == s[0] for s in found) for k in order]
    return (*counts, hashlib.sha256(",".join("%s:%d:%d" % s for s in found).encode()).hexdigest())


def digest(df):
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


PLANTED = [
    "my password = hunter2hunter2 is here", 'api_key: "Zz09+/_.=-Zz" and token=abc', "id AKIA" + "Q7" * 8 + " in a line",
    "sum " + "0f" * 20 + " end", "secret:" + "0123456789abcdef" * 3, "AKIASHORT and passwd: short", "Token='AKIA" + "Z" * 16 + "'",
]


def test_whole_table_against_brute_force(spark, tmp_path):
    """The table, and planted documents beside it: the smallest table has no secret of its own."""
    docs = table(spark, SF_DIR, "documents")
    planted = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(PLANTED)], "doc_id long, text string")
    docs.unionByName(planted, allowMissingColumns=True).write.parquet(str(tmp_path / "documents.parquet"))
    rows = table(spark, str(tmp_path), "documents").collect()
    want = sorted(((r.doc_id, *brute(r.text)) for r in rows), key=repr)
    assert digest(REGISTRY["op4_secret_scan"][0](spark, str(tmp_path))) == want
    assert len(rows) == docs.count() + len(PLANTED)
    for kind in (1, 2, 3):
        assert sum(r[kind] for r in want) >= 2


ODD = [
    (1, None), (2, ""), (None, "token=abcdefgh"), (3, "secret:token:abcdefgh12"), (3, "secret:token:abcdefgh12"),
    (4, "TOKEN = 'Zz09+/_.=-' é AKIA" + "A" * 20), (5, "f" * 31), (6, "f" * 100_000 + " x" * 50_000),
    (7, "ſecret=abcdefghij toKen=abcdefghij"), (8, "x" * 50_000 + "api_key=12345678"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ODD], "doc_id long, text string, key int, base string")
    assert digest(S.scan_digest(docs)) == sorted(((i, *brute(t)) for i, t in ODD), key=repr)
    assert S.scan_digest(docs.limit(0)).count() == 0


def spans(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return S.scan_digest(docs).first().spans


def test_weak_parts_need_their_complement(spark):
    assert spans(spark, "pwd: hunter2 and nothing else") == ""
    assert spans(spark, "user: anna likes tea") == ""
    assert spans(spark, "user: anna pwd: hunter2") == "weak_id:0:10,weak_secret:11:23"
    assert spans(spark, "see https://example.org/x for pwd: hunter2") == "weak_secret:30:42"
    assert spans(spark, "https://h.org user: anna pwd: hunter2").count("endpoint") == 1
    assert spans(spark, "user: anna\n\npwd: hunter2") == ""
    assert spans(spark, "user: anna " + "tea " * 100 + "pwd: hunter2") == ""


def test_redaction_masks_spans_and_keeps_rows(spark):
    rows = [(1, "a user: anna pwd: hunter2 z", 5), (1, "b token=abcdefgh", 6), (2, None, 7), (3, "clean", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted((tuple(r) for r in S.redact_secrets(docs).collect()), key=repr)
    assert got == [(1, "a [SECRET] [SECRET] z", 5), (1, "b [SECRET]", 6), (2, None, 7), (3, "clean", 8)]


def linked_brute(parts):
    """All pairs of the parts of one text, each against each."""
    out = []
    for key, scope, kind, start, end in parts:
        near = {
            S.ROLE[k]
            for other, sc, k, s, e in parts
            if (other, sc) == (key, scope) and s - end <= S.REACH and start - e <= S.REACH and not (s <= start and end <= e)
        } - {S.ROLE[kind]}
        wanted = {"secret": near & {"id", "endpoint"}, "id": "secret" in near, "endpoint": {"secret", "id"} <= near}
        if kind in ("weak_secret", "weak_id", "endpoint") and wanted[S.ROLE[kind]]:
            out.append((key, kind, start, end))
    return sorted(out)


def test_links_at_any_offset_length_and_gap(spark):
    rng = random.Random(4)
    parts = []
    for n in range(3000):
        at = rng.randrange(2000)
        for kind in rng.sample(list(S.ROLE), rng.choice((2, 2, 3))):
            size = rng.choice((rng.randint(4, 120), rng.randint(250, 1500)))
            parts.append((f"t{n}", 0, kind, at, at + size))
            at += size + rng.choice((1, 299, 300, 301, rng.randint(0, 310)))
    data = spark.createDataFrame(parts, "key string, scope long, kind string, start long, end long")
    by_text = {}
    for p in parts:
        by_text.setdefault(p[0], []).append(p)
    want = sorted(x for own in by_text.values() for x in linked_brute(own))
    assert sorted(tuple(r) for r in S.linked_parts(data).collect()) == want


def test_a_long_token_before_its_identifier(spark):
    token, at = "auth: " + "k." * 450, range(0, 300, 60)
    for lead in at:
        text = "x" * lead + " " + token + " user: anna"
        assert spans(spark, text) == f"weak_secret:{lead + 1}:{lead + 1 + len(token)},weak_id:{lead + 2 + len(token)}:{lead + 12 + len(token)}"
    docs = spark.createDataFrame([(1, token + " user: anna")], "doc_id long, text string")
    assert S.redact_secrets(docs).first().text == "[SECRET] [SECRET]"


def test_rows_without_parts_are_not_gathered(spark, settings):
    """Neither rows without weak parts nor NULL texts meet in one task once nothing is broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions=8,
    )
    texts = [f"user: u{i} pwd: hunter{i}" if i % 50 == 0 else None if i % 3 else f"plain {i}" for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for out in (S.scan_secrets(docs), S.redact_secrets(docs)):
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 and max(sizes) < 2000 / 4
