import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import SF_DIR

from weir.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=2000, least=10, share=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            if len(p) == 3:
                for inner in (p[:2], p[1:]):
                    longer[inner] = max(longer[inner], a)
        scored = []
        for p, a in found.items():
            if len(p) == 2 and longer[p] and 100 * longer[p] >= share * a:
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(a, b, 1, "x", 2, 3) for a, b in rows], "lang string, text string, n long, w1 string, level int, rank int").repartition(3)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "Ä", "ä", "z\x1cz"]
    rows = []
    for i in range(300):
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", " ", ". ", "\n", ",", "!"]) for w in rng.choices(words, weights=[1 / (k + 1) for k in range(64)], k=80))
        rows.append((rng.choice(["xx", "yy", None, "und"]), text + " New York City " * rng.randint(0, 2) + "; san Jose " * rng.randint(0, 3)))
    rows += [("xx", "same words same words same words same words")] * 40
    rows += [("zz", None), ("zz", ""), ("zz", "one two"), (None, None), ("qq", "rare pair"), ("q2", ".,;")]
    return rows


@pytest.mark.parametrize("top,batch", [(2000, C.OPEN), (5, C.OPEN), (3, 40), (1, 10)])
def test_against_brute_force(spark, corpus, top, batch):
    got = C.collocations(frame(spark, corpus), top, batch=batch)
    assert sorted(map(tuple, got.collect())) == brute(corpus, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_only_part_of_the_frontier_is_opened(spark, corpus, monkeypatch):
    lowered, seen = C._lowered, []

    def watched(shape, levels, wanted):
        out = lowered(shape, levels, wanted)
        seen.append({k: sum(shape[k][level:]) / sum(shape[k]) for k, level in out.items()})
        return out

    monkeypatch.setattr(C, "_lowered", watched)
    assert sorted(map(tuple, C.collocations(frame(spark, corpus), 3).collect())) == brute(corpus, 3)
    assert max(seen[0].values()) < 0.5


def test_small_tasks_and_long_texts(spark, corpus, monkeypatch):
    """Stretches of a few bytes, short word lists and early hand-over give the same counts."""
    monkeypatch.setattr(C, "STRETCH", 64)
    monkeypatch.setattr(C, "HELD", 20)
    monkeypatch.setattr(C, "LISTED", 30)
    monkeypatch.setattr(C, "BUCKETS", 10)  # most buckets are full
    rows = [("xx", ". ".join(t or "" for _, t in corpus)), *corpus[:50]]
    assert sorted(map(tuple, C.collocations(frame(spark, rows), 20).collect())) == brute(rows, 20)
    monkeypatch.setattr(C, "BITS", 8)
    monkeypatch.setattr(C, "STRETCH", 200)
    rows.append(("xx", " ".join(f"v{i} v{i % 7}" for i in range(900))))  # more words in one piece than numbers
    assert sorted(map(tuple, C.collocations(frame(spark, rows), 20).collect())) == brute(rows, 20)


def test_empty_and_rare(spark):
    assert C.collocations(frame(spark, [("xx", "a b")]).limit(0)).count() == 0
    assert C.collocations(frame(spark, [("xx", "a b c"), ("yy", None)])).count() == 0


def test_products_past_64_bits(spark):
    row = spark.createDataFrame([(4 * 10**13, 5 * 10**13, 9 * 10**13)], "a long, l long, r long")
    assert row.select(C.floor_score("a", "l", "r")).first()[0] == 10**6 * (4 * 10**13) ** 2 // (5 * 10**13 * 9 * 10**13)


def test_query_matches_its_sql(spark):
    from check_oracles import compare, connect

    assert compare(spark, connect(SF_DIR), SF_DIR, "op13_collocations") == []
