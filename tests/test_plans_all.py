"""Every registered query: no Python UDF evaluation, no cartesian or nested-loop join."""

import contextlib
import io

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def test_registered_query_plans(spark):
    offenders = {}
    for key, query in E.queries().items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            query(spark, SF_SMALL).explain("formatted")
        found = [f for f in FORBIDDEN if f in buf.getvalue()]
        if found:
            offenders[key] = found
    assert offenders == {}
