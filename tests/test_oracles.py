"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from narrakin.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module", autouse=True)
def shared_steps():
    """Build company tables and matches once per set of options instead of once per query."""
    def once(step):
        done = {}

        def cached(spark, sf, opts=queries.OPTS):
            key = repr(opts)
            if key not in done:
                done[key] = step(spark, sf, opts)
            return done[key]
        return cached

    with pytest.MonkeyPatch.context() as patch:
        for name in ("_index", "_match"):
            patch.setattr(queries, name, once(getattr(queries, name)))
        yield


def lines(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(repr([round(r[i], 10) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    if name not in entry.oracle_sql():
        assert got
        return
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert lines(got, df.columns) == lines(result.fetchall(), columns)
