"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from newslake.plans import registry
from tests.compare import database, differences

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF)


# Only these may run Python in the plan they return.
PYTHON = {"chunk_recursive", "chunk_rebuild", "embed_hashed", "embed_retry_dlq", "vector_topk", "batch_retrieval",
          "context_or_default", "html_paragraph_text", "html_fields", "page_metadata", "page_main_text",
          "search_news"}


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    frame = df.toPandas()
    assert len(frame) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    # A question asked as a literal is a relation of one row.
    assert "NestedLoopJoin" not in plan or (name == "search_news" and "OneRowRelation" in plan)
    assert name in PYTHON or not re.search("ArrowEvalPython|MapInArrow|EvalPython", plan)
    if name in SQL:
        assert differences(frame, con.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())
