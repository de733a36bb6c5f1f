"""The sliced bitemporal path (range-sliced scans, as-of differences) equals the window/join path
on the test frames, deletes and key-master expiries included."""

import os

import pytest

from tidemark.operators.temporal import plan_temporal
from tidemark.plans import frames as fr
from tidemark.plans.queries import F2_ROLES_OPR, F5_ROLES, _f2

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_f2_with_deletes(spark):
    src, tgt = _f2(spark, SF, opr=True)
    p0 = plan_temporal(src, tgt, F2_ROLES_OPR, fr.AS_OF, slice_rows=None)
    p1 = plan_temporal(src, tgt, F2_ROLES_OPR, fr.AS_OF, slice_rows=1)
    cols = ["o_custkey", "o_orderstatus", "bus_eff_ts", "bus_exp_ts"]
    _same(p0.left.select(*cols), p1.left.select(*cols))
    _same(p0.right.select(*cols), p1.right.select(*cols))
    _same(p0.merge_set, p1.merge_set)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_f5_key_master(spark):
    tgt = fr.f5_tgt(spark, SF)
    src = fr.f5_src(spark, SF, tgt)
    p0 = plan_temporal(src, tgt, F5_ROLES, fr.AS_OF, slice_rows=None)
    p1 = plan_temporal(src, tgt, F5_ROLES, fr.AS_OF, slice_rows=1)
    _same(p0.merge_set, p1.merge_set)
