"""What is to be done once: columns the optimizer must not copy, costly objects of a worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Made = TypeVar("Made")


def once_per_worker(kind: str, key: Hashable, make: Callable[[], Made], most: int = 2) -> Made:
    """``make()``, called once by a Python worker for all tasks that it runs.

    Functions of this package travel to workers by value, and their modules' variables
    with them, so what is to outlive a task is held by a module that only the worker
    has. Of each kind the last ``most`` objects are kept.
    """
    holder = sys.modules.setdefault("shelfmark_kept", types.ModuleType("shelfmark_kept"))
    held = holder.__dict__.setdefault(kind, {})
    if key not in held:
        while len(held) >= most:
            del held[next(iter(held))]
        held[key] = make()
    return held[key]


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, which the optimizer does not inline.

    As plain projections a parse or a UDF would be copied into every filter and
    field that refers to it, and run again for each.
    """
    one = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(one))
