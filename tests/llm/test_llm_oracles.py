import duckdb
import pytest

from tripgrain.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    sf_dir, duck = "/root/testdata/sf0.01", duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    expected = duck.execute(ORACLES[name])
    columns = sorted(column[0] for column in expected.description)
    order = [[column[0] for column in expected.description].index(name) for name in columns]
    theirs = sorted(tuple(row[at] for at in order) for row in expected.fetchall())
    frame = QUERIES[name](spark, sf_dir).select(*columns)
    assert sorted(map(tuple, frame.collect())) == theirs


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
