import re

import corpus_pipeline as P
import pyarrow as pa
import pytest
from conftest import SF_DIR
from test_mixing import targets, words
from test_packing import check_places, pieces
from test_secret_scan import brute as secrets

from weir.llm.common import BATCH_SETTING, repeat_rows, row_key
from weir.queries.tables import table


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def linked(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_one_by_one(spark):
    docs = table(spark, SF_DIR, "documents")
    assert [name for name, _ in P.STAGES] == ["language_id", "near_duplicates", "secret_scan", "source_mix", "best_fit_pack"]
    steps = [docs]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, steps[-1], SF_DIR)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        steps.append(spark.createDataFrame(out.collect(), docs.schema))
    start, spoken, unique, masked, mixed = ([tuple(r) for r in s.collect()] for s in steps)
    assert set(spoken) <= set(start) and {r for r in start if any(c.isalpha() for c in r[1] or "")} - set(spoken) == set()

    sets = {r[0]: shingles(r[1]) for r in spoken}
    kept = {r[0] for r in unique}
    assert set(unique) <= set(spoken) and len(unique) < len(spoken)
    for a in kept:
        assert not any(b < a and linked(sets[a], sets[b]) for b in kept if sets[a])
    for gone in set(sets) - kept:
        assert any(linked(sets[gone], s) for i, s in sets.items() if i != gone)

    assert [r[0] for r in sorted(masked)] == sorted(kept)
    texts = {r[0]: r[1] for r in unique}
    for doc_id, text, *_, n_chars in masked:
        assert n_chars == len(text) and sum(secrets(text)[:3]) == 0
        assert (text == texts[doc_id]) or sum(secrets(texts[doc_id])[:3]) or "[SECRET]" in text

    sizes = {}
    for r in masked:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    taken = dict.fromkeys(sizes, 0)
    for r in mixed:
        taken[r[3]] += words(r[1])
    assert set(mixed) <= set(masked)
    for source, want in targets(sizes).items():
        assert abs(taken[source] - want) <= max(20, 0.03 * want)

    packed = P.STAGES[-1][1](spark, steps[-1], SF_DIR).collect()
    want = sorted(p for r in mixed for p in pieces(r[0], r[1]))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    check_places(packed)


def test_run_is_the_stages(spark):
    out = P.run(spark, SF_DIR)
    assert out.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and out.count() > 0


def test_odd_rows(spark):
    rows = [(1, None, "en", None, None), (2, "", None, "a", 0), (None, "the same words here for all", "en", "a", 1), (3, "12", None, None, 2)]
    rows += [(4, "the same words here for all", "en", "b", 1), (4, "the same words here for all", "en", "b", 1), (5, "token=abcdefgh12 the end", "en", None, 1)]
    docs = spark.createDataFrame(rows, table(spark, SF_DIR, "documents").schema)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.collect() is not None, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
    unique = P.drop_near_duplicates(spark, docs, SF_DIR)
    assert rows_of(unique.select("doc_id")) == sorted([(1,), (2,), (3,), (4,), (5,)])


def test_rows_repeat_as_told(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, 1, "x"), (2, 2, None)], "a int, b int, key string")
    times = df.groupBy(row_key(df).alias("key")).count().withColumnRenamed("count", "times")
    assert rows_of(repeat_rows(df, row_key(df), times)) == rows_of(df)


@pytest.mark.parametrize("name", ["language_id", "near_duplicates", "secret_scan", "best_fit_pack"])
def test_texts_reach_python_in_small_batches(spark, name):
    """Batches of 10,000 texts of any length, several times over in each task, took an executor over its memory."""

    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    schema = table(spark, SF_DIR, "documents").schema
    long = spark.range(0, 400, 1, 1).selectExpr("id as doc_id", "concat(id, repeat(' words', 5000)) as text", "'en' as lang", "'a' as source", "30000L as n_chars")
    long = long.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema])
    few = spark.createDataFrame([(1, "some words of a text", "en", "a", 20)], schema)
    spark.conf.unset(BATCH_SETTING)
    try:
        assert dict(P.STAGES)[name](spark, few, SF_DIR).count() == 1
        sizes = long.mapInArrow(batch_sizes, "n long, size long").collect()
        assert sum(r.n for r in sizes) == 400 and max(r.size for r in sizes) < 3_000_000
        spark.conf.set(BATCH_SETTING, "1m")  # the user's choice
        P.STAGES[0][1](spark, few, SF_DIR)
        assert spark.conf.get(BATCH_SETTING) == "1m"
    finally:
        spark.conf.unset(BATCH_SETTING)
