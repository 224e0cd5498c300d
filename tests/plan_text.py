"""Executed-plan text, for assertions on the plan shape."""

from __future__ import annotations


def planned(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame) -> str:
    """Plan after adaptive execution: runs the frame first."""
    execution = frame._jdf.queryExecution()
    frame._jdf.collectToPython()
    return execution.executedPlan().toString()


def scans_of(plan: str, path_part: str) -> int:
    return sum("FileScan" in line and path_part in line for line in plan.splitlines())
