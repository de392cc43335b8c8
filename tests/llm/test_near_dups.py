import random
import re

import numpy as np
from conftest import SF_DIR

from weir.llm import near_dups as N
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(3, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        least = min((d for d in ids[root(i)] if d is not None), default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def test_whole_table(spark):
    want = brute([(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()])
    assert got(REGISTRY["op3_near_dups"][0](spark, SF_DIR)) == want
    assert any(not r[3] for r in want)


def test_chains_hubs_and_odd_rows(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(60):  # copies of a hub: alike to it, less so to each other
        words = base[:]
        for at in rng.sample(range(0, 200, 5), 4):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    rows.append((2000, " ".join(base)))
    chain = base[:]
    for i in range(12):  # each alike to the one before
        chain = chain[:]
        chain[i * 15] = f"c{i}"
        chain[i * 15 + 1] = f"d{i}"
        rows.append((3000 + i, " ".join(["chain"] * 3 + chain)))
    rows += [(5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "ONE"), (10, "one two"), (11, "Éa b c d"), (12, "éa b c d")]
    rows += [(None, "one two"), (13, "only here a b"), (13, "only here a b"), (14, "z " * 50_000), (15, "z z z")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, root int, ckey int")
    assert got(N.near_duplicates(docs)) == brute(rows)
    assert N.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_follows_similarity(spark):
    factors, offsets = N._functions(80)
    rng = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.85, 1.0):
        a = rng.integers(0, 2**63, 4000).astype(np.uint64)
        cut = round(4000 * (1 - 2 * share / (1 + share)))  # leaves that similarity
        b = np.concatenate([a[cut:], rng.integers(0, 2**63, cut).astype(np.uint64)])
        packs = [N.packed_bits(N.minima(x, factors, offsets)).view(np.int64).tolist() for x in (a, b)]
        df = spark.createDataFrame([tuple(packs)], "packed_a array<long>, packed_b array<long>")
        assert abs(df.select(N.agreement(80)).first()[0] - share) < 0.2
