"""Random small inputs against plain-Python models."""

from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings as examples
from hypothesis import strategies as st

from weir.operators import join_using, quarantine, range_checks, snapshot_as_of

KEYS = st.one_of(st.none(), st.integers(0, 3))
PAIRS = st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=8)
FEW = examples(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def joined(left, right, how):
    """Joined (key, l, r) rows; NULL keys meet nobody."""
    out = [(k, a, b) for k, a in left for j, b in right if k is not None and k == j]
    if how in ("left", "full"):
        out += [(k, a, None) for k, a in left if k is None or all(k != j for j, _ in right)]
    if how in ("right", "full"):
        out += [(j, None, b) for j, b in right if j is None or all(k != j for k, _ in left)]
    return Counter(out)


@FEW
@given(left=PAIRS, right=PAIRS)
def test_joins(spark, left, right):
    a = spark.createDataFrame(left, "k int, l int")
    b = spark.createDataFrame(right, "k int, r int")
    for how in ("inner", "left", "right", "full"):
        for hot in (False, True):
            got = join_using([a, b], "k", how, hot_keys=hot).select("k", "l", "r")
            assert Counter(rows(got)) == joined(left, right, how), (how, hot)


@FEW
@given(data=PAIRS, low=st.integers(0, 9), high=st.integers(0, 9))
def test_quarantine(spark, data, low, high):
    df = spark.createDataFrame(data, "v int, n int")
    clean, failed = quarantine(df, range_checks({"v": [low, high]}))
    passes = Counter(r for r in data if r[0] is None or low <= r[0] <= high)
    assert Counter(rows(clean)) == passes
    assert Counter((r.v, r.n) for r in failed.collect()) == Counter(data) - passes


@FEW
@given(data=PAIRS, as_of=st.integers(0, 9))
def test_snapshot(spark, data, as_of):
    log = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(data)], "k int, t int, seq int")
    latest = {}
    for i, (k, t) in enumerate(data):
        if t <= as_of:
            latest[k] = max(latest.get(k, (t, i)), (t, i))
    got = {r.k: (r.t, r.seq) for r in snapshot_as_of(log, "k", ["t", "seq"], as_of).collect()}
    assert got == latest
