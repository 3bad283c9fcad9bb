import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import build_session, ship_package

    s = build_session("tests", 4, 4)
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    return s


def _plain(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="session")
def agree(spark):
    """Run queries and their SQL over the tables of a folder; gives those that differ, with rows that only one side has."""
    import glob
    import os

    import duckdb

    def compare(queries, oracles, folder):
        con = duckdb.connect()
        con.execute("SET timezone = 'UTC'")
        for f in glob.glob(f"{folder}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
        wrong = []
        for name, sql in oracles.items():
            df = queries[name](spark, folder)
            names = sorted(df.columns)
            got = sorted(repr(tuple(_plain(r[c]) for c in names)) for r in df.collect())
            rel = con.sql(sql)
            at = [rel.columns.index(c) for c in names]
            want = sorted(repr(tuple(_plain(r[i]) for i in at)) for r in rel.fetchall())
            if got != want or names != sorted(rel.columns):
                wrong.append((name, [x for x in got if x not in want][:2], [x for x in want if x not in got][:2]))
        return wrong

    return compare
