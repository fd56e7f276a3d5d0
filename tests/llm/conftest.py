import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def same_as_sql():
    """Compare a DataFrame with DuckDB SQL over given pandas tables or the small test tables."""
    def compare(df, sql, tables=("documents", "benchmark"), given=None):
        con = duckdb.connect()
        for t in tables:
            if given and t in given:
                con.register(t, given[t])
            else:
                con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
        rel = con.sql(sql)
        names = sorted(rel.columns)
        assert names == sorted(df.columns)
        key = lambda r: tuple(str(x) for x in r)
        left = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
        right = sorted(rel.select(", ".join(names)).fetchall(), key=key)
        assert left == right
        return left
    return compare
