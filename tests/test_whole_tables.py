"""Queries over whole tables leave no row out."""

import pyarrow.parquet as pq
import pytest

from cairnlake.queries import registry


@pytest.mark.parametrize("name, source", [("member_match", "customer"), ("transaction_refs_all", "orders")])
def test_every_row_is_asked(spark, data, name, source):
    assert registry.queries()[name](spark, f"{data}/sf0.001").count() == pq.read_metadata(f"{data}/sf0.001/{source}.parquet").num_rows
