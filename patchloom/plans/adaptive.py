"""Adaptive task generation: rounds over what is still pending, with a wider mask each time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from patchloom.schemas import MASK_CAP, MASK_RATIOS
from patchloom.session import cut_lineage

Stage = Callable[[DataFrame, float, int], DataFrame]


def adaptive(tasks: DataFrame, stages: list[Stage], key: str = "instance_id", ratios: list[int] = MASK_RATIOS, cap: int = MASK_CAP) -> DataFrame:
    """Rows that pass all stages in any round.

    A stage takes pending rows, the round's ratio and the cap, and returns the
    rows that pass.  A stage without any ends the rounds.  Each round's rows are
    written to the checkpoint folder, so the plan does not grow.
    """
    done, left = None, tasks
    for ratio in ratios:
        rows = left
        for stage in stages:
            rows = cut_lineage(stage(rows, ratio, cap))
            if not rows.take(1):
                return tasks.limit(0) if done is None else done
        done = rows if done is None else done.unionByName(rows)
        left = cut_lineage(left.join(rows.select(key), key, "left_anti"))
        if not left.take(1):
            break
    return done
