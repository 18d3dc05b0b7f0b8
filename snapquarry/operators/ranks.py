"""Numbering and walking long sorted groups, however many rows one group holds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapquarry.sources.storage import written

BLOCK, FAN = 1024, 64  # places of a block; blocks that one step of the walk puts together


def ranked(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, counted from 0, of each row in its group's order; ties stand in any order.

    Two passes: rows are dealt to ranges of (group, order) and sorted there, which splits a
    large group over many tasks; then the groups' rows of each range are counted, and what
    the ranges before hold is added to a row's place within its range. Only the counts, a row
    for each group in each range, meet by group. The sorted rows are written once, since
    ranges come from a sample that need not be the same again.
    """
    sorted_ = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    at = F.monotonically_increasing_id()  # task, then place in the task
    kept = written(sorted_.withColumns({"__task": F.shiftright(at, 33), "__at": at.bitwiseAND((1 << 33) - 1)}))
    keys = [F.col(c).alias(f"__by{k}") for k, c in enumerate(by)]
    names = [f"__by{k}" for k in range(len(by))]
    counts = kept.groupBy(*keys, F.col("__task").alias("__t")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*names).orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = counts.select(*names, "__t", (before - F.col("__first")).alias("__shift"))
    same = F.col("__task") == F.col("__t")
    for c, name in zip(by, names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(name))
    return kept.join(shift, same).select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("place"))


def walk(steps: DataFrame, group: str) -> DataFrame:
    """(group, block, entry, done): where a walk through each group enters each of its blocks and how many steps it took before.

    steps: group, block, entry, exit, steps: what becomes of a walk that enters a block at
    ``entry``: where it enters the next one, and in how many steps. A walk enters block 0 at
    0. Blocks are put together ``FAN`` at a time, level by level, until one is left, and the
    entries are handed down the same way, so no task reads more than ``FAN`` blocks of a group.
    """
    kind = f"{group} string, block bigint, entry int, exit int, steps bigint"
    levels = [written(steps.select(group, F.col("block").cast("bigint").alias("block"), "entry", "exit", F.col("steps").cast("bigint").alias("steps")))]

    def joined(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = [(g.set_index("entry")["exit"], g.set_index("entry")["steps"]) for _, g in pdf.sort_values("block").groupby("block")]
        at = pdf.loc[pdf["block"] == pdf["block"].min(), "entry"].to_numpy()
        now, total = at.copy(), np.zeros(len(at), np.int64)
        for out, n in blocks:
            total += n.reindex(now).to_numpy(np.int64)
            now = out.reindex(now).to_numpy(np.int64)
        return pd.DataFrame({group: key[0], "block": key[1], "entry": at, "exit": now, "steps": total})

    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        up = levels[-1].withColumn("above", F.expr(f"block div {FAN}"))
        levels.append(written(up.groupBy(group, "above").applyInPandas(joined, kind)))
    entered = levels[-1].select(group, "block").distinct().select(group, "block", F.lit(0).alias("entry"), F.lit(0).cast("bigint").alias("done"))
    place = f"{group} string, block bigint, entry int, done bigint"

    def handed(key: tuple, below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(above):
            return pd.DataFrame({group: [], "block": [], "entry": [], "done": []})
        now, done, rows = int(above["entry"].iloc[0]), int(above["done"].iloc[0]), []
        for block, g in below.sort_values("block").groupby("block"):
            rows.append((key[0], block, now, done))
            own = g[g["entry"] == now].iloc[0]
            now, done = int(own["exit"]), done + int(own["steps"])
        return pd.DataFrame(rows, columns=[group, "block", "entry", "done"])

    for level in reversed(levels[:-1]):
        down = level.withColumn("above", F.expr(f"block div {FAN}")).groupBy(group, "above")
        entered = down.cogroup(entered.withColumnRenamed("block", "above").groupBy(group, "above")).applyInPandas(handed, place)
    return entered


def batch_steps(next_start: np.ndarray, size: int, entries: int) -> Iterator[tuple[int, int, int]]:
    """(entry, exit, steps) of a block of ``size`` places for walks that enter at a place up to ``entries``, or behind its last place if that comes first; next_start: the place after the batch that begins at each place."""
    exit_, steps = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    for k in range(size - 1, -1, -1):
        n = int(next_start[k])
        exit_[k], steps[k] = (n - size, 1) if n >= size else (exit_[n], 1 + steps[n])
    last = min(size, entries) + 1
    return zip(range(last), exit_[:last].tolist(), steps[:last].tolist(), strict=True)
