"""Folds over long arrays.

``aggregate`` copies its whole state at every step, so a state that holds a growing list makes a
fold over n items cost n². The folds here work in blocks: the list that a step copies never holds
more than what one block adds.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 128


def _empty(item_type: str) -> Column:
    return F.array().cast(f"array<{item_type}>")


def _blocks(values: Column, size: int) -> Column:
    """Numbers of the blocks of ``size`` items, from 0; none for an empty array."""
    n = F.ceil(F.size(values) / F.lit(size)).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(_empty("int"))


def running_sums(values: Column) -> Column:
    """Running sums (INT) of a bound array of INT: those of each block start from the sum of the
    blocks before. Steps copy at most ``BLOCK`` numbers, and one per block for the block sums."""

    def block(b: Column) -> Column:
        return F.slice(values, b * BLOCK + 1, BLOCK)

    def sums_from(start: Column, items: Column) -> Column:
        return F.aggregate(items, F.array(start), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))

    totals = F.transform(_blocks(values, BLOCK), lambda b: F.aggregate(block(b), F.lit(0), lambda s, x: s + x))
    starts = F.slice(sums_from(F.lit(0), totals), F.lit(1), F.size(_blocks(values, BLOCK)))
    return F.flatten(F.transform(
        starts, lambda start, b: F.slice(sums_from(start, block(b)), F.lit(2), F.lit(BLOCK))
    ))


def collect(
    values: Column, item_type: str, zero: list[Column], step: Callable, last: Callable, block: int = 8 * BLOCK,
) -> Column:
    """Fold a bound array into a list of items, for folds that yield far fewer items than they read.

    ``zero``: the fields of the state; ``step(state, x)`` gives ``[(condition, fields, item or
    None), ...]``, of which the first that holds (the last one always) is taken; ``last(state)``
    gives the array of items that remain at the end. The items of a block are collected by
    themselves and moved to the list of all items once per block."""
    names = [f"f{n}" for n in range(len(zero))]

    def state(fields, items: Column) -> Column:
        return F.struct(*[f.alias(n) for n, f in zip(names, fields)], items.alias("items"))

    def one(acc: Column, x: Column) -> Column:
        out = None
        for condition, fields, item in step([acc[n] for n in names], x):
            items = acc["items"] if item is None else F.concat(acc["items"], F.array(item))
            new = state(fields, items)
            out = F.when(condition, new) if out is None else (
                out.otherwise(new) if condition is None else out.when(condition, new))
        return out

    def of_block(acc: Column, b: Column) -> Column:
        run = acc["run"]
        start = state([run[n] for n in names], _empty(item_type))
        return F.struct(
            F.aggregate(F.slice(values, b * block + 1, block), start, one).alias("run"),
            F.concat(acc["done"], run["items"]).alias("done"),
        )

    return F.aggregate(
        _blocks(values, block), F.struct(state(zero, _empty(item_type)).alias("run"), _empty(item_type).alias("done")), of_block,
        lambda acc: F.concat(acc["done"], acc["run"]["items"], last([acc["run"][n] for n in names])),
    )
