"""Every registered key with an oracle: Spark result == DuckDB result (sf0.001)."""

import math

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()

def _rows(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9) + 0.0
        return v
    rows = [tuple(norm(x) for x in r) for r in zip(*data)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SF_SMALL).toArrow()
    exp = duck.sql(ORACLE[key]).arrow()
    if hasattr(exp, "read_all"):
        exp = exp.read_all()
    c1, r1 = _rows(got)
    c2, r2 = _rows(exp)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_keys_run(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() > 0


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["t", "zone_id", "zone_name", "cc_min", "cc_max", "cc_mean", "cc_count"]
    assert df.count() > 0
