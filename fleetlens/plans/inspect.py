"""Plan inspection: the physical plan as text, and counts of the nodes that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, pattern: str, mode: str = "simple") -> int:
    """Occurrences of a node name (regex) in the physical plan."""
    return len(re.findall(pattern, plan_text(df, mode)))


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges in the physical plan (broadcasts not counted)."""
    return count_nodes(df, r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)")


def has_single_partition_exchange(df: DataFrame) -> bool:
    return count_nodes(df, r"Exchange SinglePartition") > 0
