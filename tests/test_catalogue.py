import duckdb
import pytest

from loomspark.plans import catalogue
from tests.oracle import connection, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    same(spark, con, catalogue.QUERIES[name], catalogue.ORACLES[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_safe_change_gate_counts_and_rounds_as_its_sql(spark, tmp_path):
    """Letters that case folding or NFKC multiply, at both bounds of the gate, and ratios half a millionth apart."""
    texts = ["a" * 100, "ß" * 165, "a" * 100, "ß" * 23 + "a" * 21, "ﬁ" * 40, "…a" * 30, "", None, "½" * 9, "é" * 9]
    texts += [c for n in (41, 323, 333, 641, 1287) for c in ("b" * 640, "c" * n)]
    rows = [(i // 50, i, t) for i, t in enumerate(texts)] + [(9, 3 * i + k, t) for i in range(1, 9) for k, t in ((1, "a" * 20 * i), (2, "ß" * 33 * i))]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    same(spark, con, catalogue.QUERIES["safe_change_gate"], catalogue.ORACLES["safe_change_gate"], str(tmp_path))
