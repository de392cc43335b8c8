"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import SF_DIR, plan

import __spark_entry__ as entry
from weir.queries import REGISTRY
from check_oracles import TABLES, compare, connect


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) == []


# The skewed copies of the tables: a third of the rows share a key.
SKEWED = {
    "orders": "select * replace (if(o_orderkey % 3 = 0, 7, o_custkey) as o_custkey)",
    "lineitem": "select * replace (if(l_partkey % 3 = 0, 5, l_orderkey) as l_orderkey, "
    "if(l_partkey % 3 = 0, 3, l_suppkey) as l_suppkey)",
    "events": "select * replace (if(event_id % 3 = 0, 1, user_id) as user_id, "
    "if(event_id % 3 = 1, 9.99, value) as value)",
    "documents": "select * replace (if(doc_id % 3 = 0, 'one text', text) as text)",
}
SKEW_PRONE = [
    name
    for name in REGISTRY
    if name in entry.oracle_sql()
    and name.startswith(("join", "aggregate", "pivot", "dq", "snapshot", "job", "union"))
    or name.endswith(("percentiles", "summary", "steps", "distinct"))
]


@pytest.fixture(scope="module")
def skewed_dir(db, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        source = SKEWED.get(name, "select *")
        db.execute(f"copy ({source} from {name}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def skewed_db(skewed_dir):
    return connect(skewed_dir)


@pytest.mark.parametrize("name", SKEW_PRONE)
def test_query_matches_sql_with_hot_keys(spark, skewed_db, skewed_dir, name):
    problems = compare(spark, skewed_db, skewed_dir, name)
    assert [p for p in problems if "the check is empty" not in p] == []


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.columns[0] == "n_name" and len(out.columns) == 6
    assert out.count() > 0


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_cross_product_in_any_plan(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "Python" not in text
