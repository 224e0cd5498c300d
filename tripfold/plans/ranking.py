"""Deterministic top-K."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(frame: DataFrame, k: int, *order: Column, ties: tuple[str, ...] = ()) -> DataFrame:
    """First ``k`` rows by ``order``, then by ``ties`` ascending.

    Sort plus limit runs as a K-row heap per task and one merge of the heaps; with ties
    broken by the group keys a repeated run returns the same rows.
    """
    return frame.orderBy(*order, *ties).limit(k)
