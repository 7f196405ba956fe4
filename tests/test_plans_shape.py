"""Physical-plan shape: the scale properties the README claims, read from explain()."""

import contextlib
import io

import pytest

from pkgsync.operators import inventory as INV
from pkgsync.operators.writes import by_repository
from pkgsync.plans import migration as M
from pkgsync.session import scratch_path
from pkgsync.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def _explain(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    fx = Fixtures(spark, SF)
    root = scratch_path(spark, "shape")
    INV.store_inventory(INV.inventory(fx.fx_files.select("repository", "uri", "size_bytes"), fx.fx_repositories),
                        f"{root}/inventory")
    for n in ("fx_repositories", "fx_target", "fx_ledger_versions"):
        fx[n].write.parquet(f"{root}/{n}")
    rd = lambda n: spark.read.parquet(f"{root}/{n}")
    return M.Inputs(rd("inventory"), rd("fx_repositories"), rd("fx_target"), rd("fx_ledger_versions"))


@contextlib.contextmanager
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scope_prunes_inventory_partitions(spark, stored):
    plan = _explain(M.plan_summary(M.plan(stored)))
    assert "dynamicpruningexpression(repository" in plan
    assert "PushedFilters: [IsNotNull(version)]" in plan


def test_plan_shuffles_files_once_and_reuses_it_for_the_ledger(spark, stored):
    with no_broadcast(spark):
        plan = _explain(M.plan_summary(M.plan(stored)))
    physical = plan.split("== Physical Plan ==")[-1]
    exchanges = [ln for ln in physical.splitlines() if "Exchange hashpartitioning" in ln]
    # versions (ledger key), ledger, target, versions -> target key, summary: nothing more
    assert len(exchanges) == 5, "\n".join(exchanges)
    # the plan never reads the file path
    scans = [ln.split("ReadSchema: ")[-1] for ln in physical.splitlines()
             if "FileScan" in ln and "copy:boolean" in ln]
    assert scans and all("uri:" not in schema for schema in scans)


def test_writers_rebalance_by_repository(spark, stored):
    assert "REBALANCE_PARTITIONS_BY_COL" in _explain(by_repository(stored.inventory, ["repository", "package"]))
