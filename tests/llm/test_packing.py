import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weir.llm import packing
from weir.llm.queries import REGISTRY
from weir.queries.tables import table

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
WORDS = packing.Words(PATH)


def pieces(doc_id, text, capacity=4096):
    ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
    for n, at in enumerate(range(0, len(ids), capacity)):
        part = np.array(ids[at : at + capacity], "<u4")
        yield doc_id, n, at, len(part), zlib.crc32(part.tobytes())


def check_places(rows, capacity=4096):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)  # no gap, no overlap
        ends[r.sequence_id] = r.offset + r.length
    assert all(e <= capacity for e in ends.values())
    return len(ends)


def test_whole_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = REGISTRY["op6_best_fit_pack"][0](spark, SF_DIR).collect()
    want = sorted(p for r in docs.collect() for p in pieces(r.doc_id, r.text))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    total = sum(r.length for r in rows)
    assert check_places(rows) <= total / 4096 * 1.02 + 1


def test_odd_rows(spark):
    texts = [None, "", "a", "a", " \n ", "x" * 3000, "İstanbul ΣΑΣ\x1c\x85 œuvre é <|endoftext|> it's 12", "tie " * 9000]
    docs = spark.createDataFrame([(i // 2 or None, t, 5, 6) for i, t in enumerate(texts)], "doc_id long, text string, length int, rank int")
    rows = packing.pack(docs).collect()
    want = sorted((p for i, t in enumerate(texts) for p in pieces(i // 2 or None, t)), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == want
    check_places(rows)
    assert packing.pack(docs.limit(0)).count() == 0


@hypothesis_settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAzé Ü'sßœ\n\t.,!1 2<|>\x1ćİΣ'llre") | st.characters(codec="utf-8"), max_size=40))
def test_ids_are_the_tokenizers(text):
    assert WORDS.ids(text) == WORDS.whole(text)


def best_fit_decreasing(lengths, capacity):
    bins = []
    for l in sorted(lengths, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= l]
        if fits:
            bins[min(fits, key=lambda b: bins[b])] -= l
        else:
            bins.append(capacity - l)
    return len(bins)


@pytest.mark.parametrize("seed", range(20))
def test_rounds_equal_item_by_item_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 300).tolist()
    counts = {l: lengths.count(l) for l in set(lengths)}
    used, seen = {}, dict.fromkeys(counts, 0)
    for length, r0, n, per, s0, offset in packing.best_fit_rounds(counts, 64):
        assert r0 == seen[length]
        seen[length] += n
        for i in range(n):
            spot = (s0 + i // per, offset + i % per * length)
            assert spot not in used
            used[spot] = length
    assert seen == counts
    assert len({s for s, _ in used}) == best_fit_decreasing(lengths, 64)
