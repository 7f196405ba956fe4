"""Queries that return the target, the ledger or what requests name hold every repository's rows."""

import pytest

import __spark_entry__ as E
from pkgsync.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def _repositories(df, column="repository"):
    return {r[0] for r in df.select(column).distinct().collect()}


def _base(spark, condition):
    """Repositories of the fixture's base rows that the target or the ledger holds."""
    return _repositories(Fixtures(spark, SF).fx_base.where("t <> 3").where(condition))


@pytest.mark.parametrize("name,column", [("tgt_repositories", "name"), ("tgt_versions", "repository")])
def test_target_holds_every_repository(spark, name, column):
    want = _base(spark, "l_orderkey % 3 <> 0")
    assert "repo-8" in want
    assert _repositories(E.queries()[name](spark, SF), column) == want


@pytest.mark.parametrize("name", ["repository_package", "ledger_packages", "ledger_versions", "ledger_refresh", "fetched_repositories"])
def test_ledger_holds_every_repository(spark, name):
    want = _base(spark, "l_orderkey % 2 = 0")
    assert "repo-12" in want
    assert _repositories(E.queries()[name](spark, SF)) == want


def test_known_versions_of_every_repository(spark):
    assert "repo-12" in _repositories(E.queries()["known_versions"](spark, SF))


def test_refresh_and_plan_follow_the_requests(spark):
    named = _repositories(Fixtures(spark, SF).fx_requests)
    refreshed = E.queries()["ledger_refresh"](spark, SF).where("all_versions_fetched = 0 and all_versions_published = 0")
    assert _repositories(refreshed) == named & _base(spark, "l_orderkey % 2 = 0")
    assert _repositories(E.queries()["repository_plan"](spark, SF)) == _repositories(E.queries()["versions"](spark, SF)) & named
