"""Plan checks through the public ``explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Physical operators that mean rows leave the JVM for a Python worker.
PYTHON_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string (no action runs)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def uses_python(df: DataFrame) -> bool:
    """True when any physical operator hands rows to a Python worker."""
    text = plan_text(df, "simple")
    return any(op in text for op in PYTHON_OPERATORS)


def count_shuffles(df: DataFrame) -> int:
    """Shuffle exchanges in the physical plan; after an action, only the final adaptive
    plan is counted, and reused exchanges are not counted again."""
    text = plan_text(df, "simple").split("== Initial Plan ==")[0]
    lines = [ln for ln in text.splitlines() if "ReusedExchange" not in ln]
    pattern = r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)"
    return sum(1 for ln in lines if re.search(pattern, ln))


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` list of every file scan in the plan."""
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "simple"))
