import duckdb
import pytest

import __spark_entry__ as E
from corpusloom.plans import registry

SAMPLE = ["a1_code_sets", "a5_propp_sequences", "a8_bakhtin_profiles", "c2_edges", "c24_validate", "c8_structure", "c14_decisions", "f11_f12_citations", "p5_found", "q13_nearest", "k3_upsert"]


def test_registries_agree():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, sf, name):
    import os

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    got, want = registry.queries()[name](spark, sf).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    norm = lambda d: sorted(str([None if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r]) for r in d[sorted(d.columns)].itertuples(index=False, name=None))
    assert sorted(got.columns) == sorted(want.columns) and norm(got) == norm(want)


def test_entry(spark):
    assert E.entry(spark).count() > 0
