"""Every registered query that has SQL, against DuckDB on the smallest fixture."""

import glob
import math
import os

import pytest

from skein.plans import catalogue

FIXTURE = os.environ.get("SKEIN_FIXTURE", "/root/testdata/sf0.001")
#: The smallest fixture has no labelled candidate, without which a sample is an error.
LABELLED = {"sample_counts", "bounded_sample_counts"}
pytestmark = pytest.mark.skipif(not os.path.isdir(FIXTURE), reason="no fixture")


def _folder(name):
    return os.path.join(os.path.dirname(FIXTURE.rstrip("/")), "sf0.01") if name in LABELLED else FIXTURE


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("null" if x is None or isinstance(x, float) and math.isnan(x) else repr(float(x)) if isinstance(x, float) else str(x) for x in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{_folder(name)}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = catalogue.queries()[name](spark, _folder(name)).toPandas()
    want = con.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_every_query_has_a_plan(spark):
    for name, query in catalogue.queries().items():
        if name in catalogue.oracle_sql():
            assert query(spark, _folder(name)).columns


def test_gbt_scores_train_with_the_defaults(spark, monkeypatch):
    from skein.operators import model, sampling

    seen, rows, train = {}, sampling.training_rows, model.train
    small = model.ModelParams(num_boost_round=2, num_leaves=7, min_data_in_leaf=2)

    def training_rows(labelled, *args, **kw):
        seen["rows"] = (args, kw)
        return rows(labelled, 10)

    def trained(labelled, names, params=model.ModelParams()):
        seen["params"] = params
        return train(labelled, names, small)

    monkeypatch.setattr(sampling, "training_rows", training_rows)
    monkeypatch.setattr(model, "train", trained)
    fixture = os.path.join(os.path.dirname(FIXTURE.rstrip("/")), "sf0.01")
    assert catalogue.queries()["gbt_scores"](spark, fixture).count() > 0
    assert seen == {"rows": ((), {}), "params": model.ModelParams()}
