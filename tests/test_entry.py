import pytest
from conftest import SF

import __spark_entry__ as entry
from gableframe.plans.catalog import QUERIES
from gableframe.plans.catalog_sql import ORACLE
from gableframe.sources import workspace as ws


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 18 and {r.split for r in rows} == {"train", "eval", "holdout"}


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLE) == {
        "random_forest", "gbt", "all_candidates", "tuned_trials", "loaded_model_info",
    }


def test_splits_are_disjoint_and_complete(spark):
    tagged = entry.queries()["temporal_split"](spark, SF)
    assert tagged.count() == tagged.select("row_id").distinct().count()
    assert entry.queries()["date_features"](spark, SF).count() == tagged.count()


def test_no_python_in_the_plans(spark):
    for name in ("clean_listings", "feature_frame", "request_scoring", "request_contract"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        def __init__(self, values):
            self.get = lambda key, default=None: values.get(key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="shared"):
        ws.workspace(Session())
    assert ws.workspace(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
