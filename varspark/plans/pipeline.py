"""Chains of stages in one plan."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame

from ..operators.slots import Step, annotate


def pipeline(df: DataFrame, stages: Iterable[Callable[[DataFrame], DataFrame] | Step], key: list[str] | None = None, by_lists: bool = False) -> DataFrame:
    """Applies stages one after another; nothing is written between them, and Catalyst sees one plan.

    Steps that follow each other share one long layer: their lists are exploded once and packed once.  ``key``: columns that
    identify a row (else rows are staged with an id).  ``by_lists``: rows share their lists, each combination of which is annotated once."""
    runs: list[list] = []
    for s in stages:
        if isinstance(s, Step) and runs and isinstance(runs[-1][0], Step):
            runs[-1].append(s)
        else:
            runs.append([s])
    return reduce(lambda d, run: annotate(d, *run, key=key, by_lists=by_lists) if isinstance(run[0], Step) else run[0](d), runs, df)
