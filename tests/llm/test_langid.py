import zlib

import numpy as np
from conftest import SF_DIR

from weir.llm import langid as L
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, SF_DIR, "documents").collect()}
    rows = REGISTRY["op2_language_id"][0](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and docs[r.doc_id].lang and r.lang_pred != "und"]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in judged)
    assert len(judged) > 20 and right >= 0.95 * len(judged)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or ""))


ENGLISH = "the quick brown fox jumps over the lazy dog and then it sleeps in the warm sun of the afternoon "
GERMAN = "der schnelle braune fuchs springt über den faulen hund und dann schläft er in der warmen sonne "


def test_mixture_and_odd_rows(spark):
    rows = [(i, ENGLISH * 3, "en") for i in range(40)] + [(100 + i, GERMAN * 3, "de") for i in range(40)]
    odd = [(900, ENGLISH * 10 + GERMAN * 5, None), (901, None, "en"), (902, "", "de"), (903, "12 .. 34!", "en"), (None, GERMAN, "en")]
    odd += [(904, GERMAN * 2000, None), (905, "\x00 und der hund", None), (906, "𐐀", None), (0, ENGLISH * 3, "en")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "doc_id long, text string, lang string, score int, held_out int")
    got = {}
    for r in L.fit_and_identify(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[0]) == 2 and got[None][0].lang_pred == "de" and not got[None][0].held_out
    mixed = got[900][0]
    assert mixed.lang_pred == "en" and 0.55 < mixed.score < 0.8 and "de:" in mixed.languages
    assert [got[i][0].lang_pred for i in (901, 902, 903)] == ["und"] * 3
    assert got[904][0].lang_pred == got[905][0].lang_pred == "de" and got[904][0].score > 0.99
    assert got[906][0].lang_pred in ("de", "en")
    assert L.fit_and_identify(docs.limit(0)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in L.fit_and_identify(unlabelled).collect()} == {"und"}


def test_em_recovers_proportions():
    rng = np.random.default_rng(1)
    truth = rng.choice(3, 2000, p=[0.6, 0.3, 0.1])
    scores = np.where(np.arange(3) == truth[:, None], 0.0, -6.0)
    share = L.mixtures(scores, np.zeros(2000, int), 2)
    assert np.allclose(share[0], np.bincount(truth) / 2000, atol=0.02) and share[1].sum() == 0
    one = L.mixtures(np.where(np.arange(3) == 1, -1.0, -1.01) * np.ones((50, 1)), np.zeros(50, int), 1)
    assert (one[0] > 0).sum() == 1  # no evidence pays for a second language
