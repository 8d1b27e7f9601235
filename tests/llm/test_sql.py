"""Numbered queries on a given table against their SQL in DuckDB."""

import pytest

from __spark_entry__ import oracle_sql, queries
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op7_bit_sliced_topk", "op10_warc", "op11_line_dedup", "op12_hard_negatives",
                                  "op13_merkle_manifest"])
def test_same_as_sql(spark, name):
    frame = queries()[name](spark, SF)
    assert frame.count() > 0 and differences(frame, connect(SF), oracle_sql()[name]) == []
