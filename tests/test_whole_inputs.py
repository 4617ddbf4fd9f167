"""Queries over whole columns, next to those over chosen rows or literals."""

import pytest

from check_queries import compare, connect
from workload import inputs
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["external_count", "external_count_all", "label_rules_text"])
def test_equal_to_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name]) is None


def test_every_company_is_counted(spark):
    names = {r.company_name for r in inputs.aggregator_postings(spark, FOLDER).collect()} - {None}
    found = {r.company_name: r.job_count for r in QUERIES["external_count_all"](spark, FOLDER).collect()}
    assert set(found) == names | {"No Such"} and found["No Such"] == 0
    assert sum(found.values()) == inputs.aggregator_postings(spark, FOLDER).where(
        "company_name is not null").count()


def test_stored_companies_without_postings_count_zero(spark):
    stored = {r.c_name for r in spark.read.parquet(f"{FOLDER}/customer.parquet").collect()}
    found = {r.company_name: r.job_count for r in QUERIES["external_count"](spark, FOLDER).collect()}
    assert stored <= set(found) and all(found[name] == 0 for name in stored)
    assert any(found.values())


def test_label_rules_read_every_row(spark):
    count = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet").count()
    found = QUERIES["label_rules_text"](spark, FOLDER).groupBy("source").count().collect()
    assert dict(map(tuple, found)) == {
        "p_type": count("part"), "p_name": count("part"), "text": count("documents"),
        "literal": len(inputs.COMMITMENTS)}
