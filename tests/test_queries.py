"""Every registered query: values against its SQL, and the shape of its plan."""

import io
from contextlib import redirect_stdout

import pytest
from oracle import compare, connect

from tamarack.plans import REGISTRY


@pytest.fixture(scope="module")
def con(root):
    return connect(root)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, root, con, name):
    q = REGISTRY[name]
    df = q.run(spark, root)
    if q.sql:
        assert compare(df, con, q.sql) is None
    else:
        assert df.count() > 0

    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    plan = out.getvalue()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # A window over unpartitioned rows would run in one task; only the one row
    # per slice of a range partitioning may.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            above = " ".join(lines[max(0, i - 2) : i])
            assert "Window" not in above or "__slice" in above
