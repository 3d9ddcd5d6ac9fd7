"""Driver contract and a sample of the oracle gate at sf0.001."""
import os

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["era", "automation_level", "n", "severe_rate"]
    assert len(rows) >= 1


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["latest_version", "consolidate", "severe_rate", "narrative_flags",
                                  "threshold_sweep", "roc_auc", "cluster_profile", "scenario_label",
                                  "data_dictionary", "silhouette"])
def test_oracle_sample(spark, name):
    if not os.path.exists(SF_SMALL):
        pytest.skip("no test data")
    info = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert info["ok"], info
