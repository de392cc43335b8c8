import hashlib
import random

import numpy as np
import pytest
from conftest import SF_DIR

from weir.llm import repeats as R
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def brute(rows, length=100):
    """All strings in order of document and place; a string seen before is covered."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            s = s if length <= 16 else hashlib.md5(s).digest()
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def test_whole_table(spark):
    want = brute([(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()])
    assert got(REGISTRY["op8_repeats"][0](spark, SF_DIR)) == want
    assert sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("seed", range(3))
def test_passages_copies_and_odd_rows(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (19, 20, 21, 22, 30, 80)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 4)):
            whole = rng.choice(shared)
            a = rng.randrange(0, 20)
            parts += [whole[a : len(whole) - rng.randrange(0, 20)], text(rng.randrange(0, 6))]
        rows.append((i * 3, "".join(parts)))
    rows += [(500, rows[7][1]), (501, rows[7][1][:-1] + "!"), (502, "x" * 3000), (503, "ab " * 700), (504, "x" * 99), (505, "x" * 100), (506, "x" * 101)]
    rows += [(507, None), (508, ""), (509, text(4000) + rows[9][1]), (None, rows[9][1]), (510, rows[11][1]), (510, rows[11][1]), (511, "short"), (511, "short")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, th int, pos int")
    assert got(R.remove_repeats(docs)) == brute(rows)
    assert got(R.remove_repeats(docs, shard=2)) == brute(rows)  # anchors of many shards
    assert R.remove_repeats(docs.limit(0)).count() == 0


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(0)
    inner = rng.integers(97, 100, 130).astype(np.uint8)
    for _ in range(20):
        a, b = (np.concatenate([rng.integers(97, 100, rng.integers(0, 90)), inner, rng.integers(97, 100, 50)]).astype(np.uint8) for _ in range(2))
        sets = []
        for data in (a, b):
            at = next(i for i in range(len(data)) if (data[i : i + 130] == inner).all())
            places, _, least = R.anchors(data, np.full(len(data), len(data)))
            sets.append([[int(p) - at - s for p in places if s <= p - at <= s + 68] for s in range(31)])
            assert (least[at : at + 31] > 0).all() and all(sets[-1])
        least = [R.anchors(d, np.full(len(d), len(d)))[2] for d in (a, b)]
        assert set(least[0][least[0] > 0].tolist()) & set(least[1][least[1] > 0].tolist())
