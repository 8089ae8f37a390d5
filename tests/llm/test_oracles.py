"""The numbered queries that have SQL, and the columns of all of them."""

import parity
import pytest

from codexflow.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    assert parity.difference(QUERIES[name](spark, SF_DIR), parity.connect(SF_DIR), ORACLE_SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_each(spark, name):
    table, key = {"op9_warc": ("pages", "page_id"), "op11_repair": ("conversations", "conv_id"), "op13_codes": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    found = QUERIES[name](spark, SF_DIR)
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    rows = rows.distinct() if name == "op11_repair" else rows
    assert sorted(r[key] for r in found.select(key).collect()) == sorted(r[key] for r in rows.collect())
