import hashlib
import random
import re

from conftest import SF_DIR, plan
from pyspark.sql import functions as F

from weir.llm import pii
from weir.llm.queries import REGISTRY
from weir.queries.tables import table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    return kind == "email" or (16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15)


def brute(text):
    spans = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "", re.A) if valid(k, m[0])]
    counts = [sum(s[0] == k for s in spans) for k in PATTERNS]
    return (*counts, hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest())


def digest(df):
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in df.collect()), key=repr)


def test_whole_table(spark):
    want = sorted(((r.doc_id, *brute(r.text)) for r in table(spark, SF_DIR, "documents").collect()), key=repr)
    got = REGISTRY["op10_pii"][0](spark, SF_DIR)
    assert digest(got) == want
    assert all(sum(r[i] for r in want) for i in (1, 4))
    text = plan(got)
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


ODD = [
    None, "", "a@b.c_d@e.f g@h", "x" * 20_000 + "@" + "y" * 20_000, "a.b@" + "c." * 10_000 + "d", "1.2.3.4.5.6.7.8 001.2.3.255 1.2.3.256",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "1" * 60_000, "1 " * 60_000, "1." * 30_000, "+1 (555) 123-4567 +49 30 1234 +1", "+" * 9000,
    "é😀 a@b.de ü+441234567890", "4111111111111111", "5500005555555559 12", "ſ@b.c K@d.e", "+1" + "2 " * 20_000, "@" * 5000, "a" * 100_000,
    "0000000000000000", "é@b.c", "1.2.3.4@5.6",
]


def test_odd_rows(spark):
    rows = [(i // 2 or None, t, 1, 2) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid int, spans int")
    assert digest(pii.find_digest(docs)) == sorted(((i, *brute(t)) for i, t, *_ in rows), key=repr)
    assert pii.find_digest(docs.limit(0)).count() == 0


def test_terms_that_give_an_entity_away(spark):
    secret = [f"filler{i} the zanzibar office asks you to write jo@x.org or wait filler{i}" for i in range(3)]
    licence = [f"license{i} text of the licence by info@lib.org under the licence license{i}" for i in range(40)]
    other = [f"the office and you wait to write text number{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(secret + licence + other)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_digest(docs).collect()}
    at = secret[0].index("zanzibar")
    assert f"term:{at}:{at + 8}" in rows[0].spans.split(",") and rows[0].n_term < 6
    assert all(rows[i].spans == "" for i in range(43, 103))
    assert all(rows[i].n_term == 0 for i in range(3, 43))  # one address for all says little
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "jo@x.org" not in clean[0] and "[EMAIL]" in clean[0] and "zanzibar" not in clean[0] and "filler0" in clean[0]
    assert clean[50] == docs.filter("doc_id = 50").first().text
    copies = spark.createDataFrame([(i, secret[0]) for i in range(5)] + [(9, "x"), (10, None)], "doc_id long, text string")
    assert {r.n_term for r in pii.find_digest(copies).collect()} == {0}  # copies are one context
    gone = pii.sanitise(copies, remove=True).filter("doc_id = 1").first().text
    assert gone == secret[0].replace("jo@x.org", "")


def test_surroundings_reach_past_other_matches(spark):
    rng = random.Random(3)
    bits = ["a@b.cd", "1980", "4111111111111111", "4111 1111", " ", ", ", "Word", "é😀", "x" * 90, "1.2.3.4", "9" * 100, "+49 30 123456", ";", "22"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(150)] + ["11 " * 60 + "a@b.cd 4111111111111111" + " 22" * 60, "a@b.cd," * 90]
    rows = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    rows = rows.select("rid", F.concat(*[pii._parts(kind) for kind in pii.PATTERNS]).alias("parts"))
    got = pii.base_matches(rows).collect()
    assert len(got) == sum(sum(brute(t)[:4]) for t in texts) > 500
    for r in got:
        text = texts[r.rid]
        assert text[r.start : r.end] == r.hit
        assert r.before == text[max(r.start - pii.NEAR, 0) : r.start] and r.after == text[r.end : r.end + pii.NEAR]


def test_numbers_before_a_card_hide_no_terms(spark):
    def terms(middle):
        fill = lambda i: f"filler{i} the zanzibarian Smithson{middle} card 4111 1111 1111 1111 or wait filler{i}"
        other = [f"the office and you wait or card text number{i}" for i in range(60)]
        docs = spark.createDataFrame(list(enumerate([fill(i) for i in range(3)] + other)), "doc_id long, text string")
        row = pii.find_digest(docs).filter("doc_id = 0").first()
        return {fill(0)[int(s.split(":")[1]) : int(s.split(":")[2])] for s in row.spans.split(",") if s.startswith("term")}

    for middle in (", born in May,", ", born 1980,", ", paid 20.50 on 12 11 2023,"):
        assert {"zanzibarian", "Smithson"} <= terms(middle)


def test_whole_words_at_the_edge_of_the_surroundings_are_terms(spark):
    """A word that ends or begins 80 code points away, or touches the entity, counts unless letters go on."""
    rng = random.Random(4)
    bits = ["jo@x.org", "1.2.3.4", "+49 30 123456", "+441234567890 ", " ", "-", "word", "épée ", "Ab12 ", "éé", "x" * 30, "a b c ", "Tel"]
    texts = ["".join(rng.choices(bits, k=rng.randint(5, 60))) for _ in range(200)]
    texts += ["x" * k + " first " + "- " * 36 + "jo@x.org" + " -" * 37 + " last " + "y" * k for k in (0, 1, 5)]
    texts += ["- " * 60 + "Tel+49 30 123456 x", "- " * 60 + "abc1.2.3.4 x", "abc1.2.3.4xyz - -", "- " * 60 + "firstabc " + "- " * 36 + "jo@x.org"]
    rows = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    parts = rows.select("rid", F.concat(*[pii._parts(kind) for kind in pii.PATTERNS]).alias("parts"))
    matches = pii.base_matches(parts)
    want, cut = set(), 0
    for m in matches.collect():
        for w in re.finditer(r"[^\W_]{3,}", texts[m.rid]):
            near = m.start - pii.NEAR <= w.start() and w.end() <= m.start or m.end <= w.start() and w.end() <= m.end + pii.NEAR
            if near:
                want.add((m.rid, f"{m.kind}:{m.hit.lower()}", w[0].lower(), w.start(), w.end()))
                cut += pii.NEAR in (m.start - w.start(), w.end() - m.end)
    got = {(r.rid, r.entity, r.term, r.start, r.end) for r in pii.context_terms(matches).collect()}
    assert got == want and cut > 10
