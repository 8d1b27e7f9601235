"""Every registered query against its SQL counterpart in DuckDB, and the shape of its plan."""

import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.queries import REGISTRY
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_result(spark, duck, name):
    frame = queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("NestedLoop", "Cartesian", "Python", "MapInPandas") if bad in plan]
    assert differences(frame, duck, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_facts_are_not_shuffled_before_a_direct_recode(spark):
    plan = queries()["geo_block"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 6


def test_scan_reads_only_needed_columns(spark):
    plan = queries()["geo_county"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_tax" not in plan


def test_entry_without_the_packages_of_the_training_data_queries():
    """The headcount queries are there when an import of the other ones fails."""
    code = ("import sys, warnings; sys.modules['public_tokenizers'] = None; warnings.simplefilter('ignore');"
            "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) == set(e.queries()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=Path(__file__).parent.parent).stdout
    assert out.split() == [str(len(REGISTRY)), "True"]
