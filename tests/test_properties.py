"""Property tests: rounding against DuckDB, arg-max names against a plain definition."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from airlens.functions.constants import POLLUTANTS
from airlens.functions.expr import argmax_names, round_half

_con = duckdb.connect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=200),
       st.integers(min_value=0, max_value=4))
def test_round_half_equals_duckdb_round(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half("x", digits)).collect()]
    want = [r[0] for r in _con.execute(f"SELECT round(x, {digits}) FROM (SELECT unnest(?::double[]) AS x)",
                                       [values]).fetchall()]
    assert got == want


def _argmax_plain(row):
    present = [v for v in row if v is not None]
    if not present:
        return []
    top = max(present)
    return [n for n, v in zip(POLLUTANTS, row) if v is not None and v == top]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.integers(min_value=0, max_value=7))] * 5),
                min_size=1, max_size=100))
def test_argmax_names_equals_plain_definition(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    got = [r[0] for r in df.select(argmax_names(["a", "b", "c", "d", "e"])).collect()]
    assert got == [_argmax_plain(r) for r in rows]
