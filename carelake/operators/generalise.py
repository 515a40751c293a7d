"""The finest level of detail at which every published group holds enough people."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.suppression import MINIMUM_CELL

ALL = "*"
Node = tuple[int, ...]


@dataclass(frozen=True)
class Hierarchy:
    """A column and its levels of detail, finest first; each level's value must follow from the one before."""

    column: str
    levels: tuple[Callable[[Column], Column], ...]

    def at(self, level: int) -> Column:
        return self.levels[level](F.col(self.column)).alias(self.column)


def as_it_is(value: Column) -> Column:
    return value


def merged(_: Column) -> Column:
    return F.lit(ALL)


def loss(node: Node, hierarchies: Sequence[Hierarchy]) -> Fraction:
    """Sum of the shares of each column's levels that the node has gone up."""
    return sum((Fraction(n, len(h.levels) - 1) for n, h in zip(node, hierarchies, strict=True) if n), Fraction(0))


def rolled_up(cells: DataFrame, hierarchies: Sequence[Hierarchy], node: Node, keep: Sequence[str], count: str) -> DataFrame:
    """The cells at the node's levels; `keep` columns are never generalised."""
    levels = [h.at(n) for h, n in zip(hierarchies, node, strict=True)]
    return cells.groupBy(*keep, *levels).agg(F.sum(count).alias(count))


def finest_node(
    cells: DataFrame, hierarchies: Sequence[Hierarchy], keep: Sequence[str], count: str, minimum: int = MINIMUM_CELL,
) -> Node | None:
    """The node of least `loss` (then of the least levels from the left) whose groups all hold `minimum`; None if none does.

    Groups only grow when a level goes up. So a node that fails rules out every finer one, a node that holds every
    one of greater loss, and the walk halves what is left: it asks about the middle of the open nodes. Each question is one
    aggregation of the cells, of which only the smallest group reaches the driver. No cells at all hold at every node.
    """
    open_nodes = sorted(product(*(range(len(h.levels)) for h in hierarchies)), key=lambda n: (loss(n, hierarchies), n))
    best = None
    while open_nodes:
        at = len(open_nodes) // 2
        node = open_nodes[at]
        smallest = rolled_up(cells, hierarchies, node, keep, count).agg(F.min(count)).first()[0]
        if smallest is None or smallest >= minimum:
            best, open_nodes = node, open_nodes[:at]
        else:
            open_nodes = [n for n in open_nodes if any(a > b for a, b in zip(n, node, strict=True))]
    return best


def generalised(
    cells: DataFrame, hierarchies: Sequence[Hierarchy], keep: Sequence[str], count: str, minimum: int = MINIMUM_CELL,
) -> DataFrame:
    """The cells at the finest publishable node, with its levels as `niveau_<column>`.

    cells: additive counts, one row or more per group at the finest level, on a written table, as every question scans it.
    Groups of the `keep` columns that hold fewer than `minimum` as a whole are left out first: no node can publish them, and
    they would decide over all others.
    """
    whole = cells.groupBy(*keep).agg(F.sum(count).alias("_whole")).filter(F.col("_whole") >= minimum).drop("_whole")
    same = None
    for column in keep:
        equal = cells[column].eqNullSafe(whole[column])
        same = equal if same is None else same & equal
    enough = cells if same is None else cells.join(whole, same, "left_semi")
    node = finest_node(enough, hierarchies, keep, count, minimum)
    if node is None:  # nothing is kept apart and all rows together are too few
        node, enough = tuple(len(h.levels) - 1 for h in hierarchies), enough.limit(0)
    levels = [F.lit(n).alias(f"niveau_{h.column}") for h, n in zip(hierarchies, node, strict=True)]
    return rolled_up(enough, hierarchies, node, keep, count).select("*", *levels)
