"""Exact percentiles that survive hot groups, in two passes over the rows.

One buffer per group would hold a hot group in one task, and a histogram of all
values is as large as the data when they are distinct. Instead:

1. **Summary.** Every value falls into a cell of about 0.8 % relative width
   (``cell``), whose number rises with the value. Counts per (group, cell) are
   combined on the map side and shuffled: at most some thousands of rows a group,
   whatever its size. Running counts over a group's cells give its total and, for
   each wanted rank, the one cell that holds it, with the rows before it. Only these
   cells are written.
2. **Bracket.** The rows are read again, those outside the wanted cells dropped by a
   join with them (broadcast up to ``BROADCAST_ROWS`` cells), and the values inside
   counted exactly: ``(group, value)`` histograms of the brackets alone, written once.
3. The rank of a value is the rows before its cell plus the running count inside it.
   The values at the wanted ranks are picked, and interpolated linearly for
   ``percentile_cont`` (the SQL definition).

Calling a function here runs the two passes; what it returns reads the written
brackets. Brackets of more than ``ONE_TASK_ROWS`` rows (values packed into a narrow
range) are dealt out in ranges of (group, value) and ranked range by range, so a task
never orders a whole hot group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripmart.config import REFERENCE
from tripmart.operators.joins import bounded
from tripmart.session import new_table_path

#: Cells for each factor of e between two values.
CELLS = 128
#: More than CELLS times the logarithm of any double's size: keeps cells of one sign apart from those of the other.
ZERO = 1 << 18
BROADCAST_ROWS = REFERENCE.broadcast_max_rows
ONE_TASK_ROWS = 5_000_000


def cell(value: Column) -> Column:
    """A whole number that never falls as a numeric value rises: its logarithm in steps
    of 1/CELLS, by sign; NaN, which sorts last, has the highest."""
    d = value.cast("double")
    size = F.floor(F.ln(F.least(F.abs(d), F.lit(1.7976931348623157e308))) * CELLS) + ZERO
    return (F.when(F.isnan(d), F.lit(1 << 40)).when(d > 0, size).when(d < 0, -size)
            .when(d == 0, F.lit(0)).cast("long"))


def _histogram(df: DataFrame, groups: Sequence[str], value: Column) -> DataFrame:
    g = list(groups)
    hist = (df.select(*g, value.alias("_v"))
            .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_n0")))
    # NULL values stay as a row (so an all-NULL group still appears) but count 0
    return hist.select(*g, "_v", F.when(F.col("_v").isNotNull(), F.col("_n0"))
                       .otherwise(F.lit(0)).alias("_n"))


def _join_on_groups(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL group is a group)."""
    r = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        eq = left[k].eqNullSafe(r[f"_r{i}"])
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, how).drop(*[f"_r{i}" for i in range(len(keys))])


def _order(groups: Sequence[str], *by: str):
    return Window.partitionBy(*groups).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _written(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    path = new_table_path(df.sparkSession, name)
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in measures.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(obs.get)


def _brackets(df: DataFrame, groups: Sequence[str], ranks: Sequence[Callable[[Column], Column]]) -> tuple[DataFrame, dict]:
    """df: groups, _v, _cell. The cells that hold a wanted rank: groups, _cell, _n
    (rows), _before (rows of the group in lower cells), _tot (its rows); for a group
    without a value one row without a cell."""
    g = list(groups)
    counts = df.groupBy(*g, "_cell").agg(F.count("_v").alias("_n"))
    counts = counts.select(*g, "_cell", "_n", (F.sum("_n").over(_order(g, "_cell")) - F.col("_n")).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(*g)).alias("_tot"))
    held = F.lit(False)
    for rank in ranks:
        r = rank(F.col("_tot"))
        held |= (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n"))
    return _written(counts.where(held | (F.col("_tot") == 0)), "brackets", inside=F.sum("_n"))


def _ranked_values(df: DataFrame, groups: Sequence[str], value: Column,
                   ranks: Sequence[Callable[[Column], Column]]) -> DataFrame:
    """``groups, _v, _n, _cum, _tot`` for the values around the wanted ranks
    (functions of a group's total): the running count ``_cum`` is that of the whole
    group. Every group has a row, also without a value."""
    g = list(groups)
    rows = df.select(*g, value.alias("_v")).withColumn("_cell", cell(F.col("_v")))
    wanted, size = _brackets(rows, g, ranks)
    keys = bounded(wanted.where(F.col("_cell").isNotNull()).drop("_n"), BROADCAST_ROWS, size["rows"])
    # what is known of a cell travels with its values
    in_cell = [*g, "_cell"]
    hist = _histogram(_join_on_groups(rows, keys, in_cell), [*in_cell, "_before", "_tot"], F.col("_v"))
    many = (size["inside"] or 0) > ONE_TASK_ROWS
    if many:
        hist = hist.repartitionByRange(*g, "_v").withColumn("_part", F.spark_partition_id())
    hist, _ = _written(hist, "histogram")
    if many:
        parts = hist.groupBy(*in_cell, "_part").agg(F.sum("_n").alias("_pn"))
        parts = parts.select(*in_cell, "_part", (F.sum("_pn").over(_order(in_cell, "_part")) - F.col("_pn")).alias("_off"))
        upto = _order([*in_cell, "_part"], "_v")
        running = _join_on_groups(hist.withColumn("_inner", F.sum("_n").over(upto)), parts, [*in_cell, "_part"])
        inner = F.col("_off") + F.col("_inner")
    else:
        # one exchange, on the groups, serves the running count and the pick
        running, inner = hist.repartition(*g), F.sum("_n").over(_order(in_cell, "_v"))
    running = running.select(*g, "_v", "_n", (F.col("_before") + inner).alias("_cum"), "_tot")
    without = wanted.where(F.col("_cell").isNull()).select(*g, "_tot")
    return running.unionByName(without, allowMissingColumns=True)


def _picked(df: DataFrame, groups: Sequence[str], value: Column, ranks: dict[str, Callable[[Column], Column]],
            *more: Column) -> DataFrame:
    """One row per group (one row in all without groups): the value at each rank."""
    g = list(groups)
    ranked = _ranked_values(df if g else df.withColumn("_all", F.lit(0)), g or ["_all"], value, list(ranks.values()))
    return ranked.groupBy(*g).agg(*[_value_at(r(F.col("_tot"))).alias(k) for k, r in ranks.items()], *more)


def _value_at(rank: Column) -> Column:
    """Aggregate: the value whose rank range holds ``rank``."""
    hit = (F.col("_cum") - F.col("_n") <= rank) & (rank < F.col("_cum"))
    return F.max(F.when(hit, F.col("_v")))


def percentile_cont(df: DataFrame, groups: Sequence[str], value: Column,
                    probs: dict[str, float]) -> DataFrame:
    """Exact continuous percentiles of ``value`` per group.

    ``probs`` maps output column -> p in [0, 1]. Groups whose values are all
    NULL get NULL. Output: group columns + one double column per entry."""
    ranks, fractions, finals = {}, [], []
    for name, p in probs.items():
        pos = lambda tot, p=p: (tot - 1).cast("double") * float(p)
        ranks[f"_{name}_lo"] = lambda tot, pos=pos: F.floor(pos(tot))
        ranks[f"_{name}_hi"] = lambda tot, pos=pos: F.ceil(pos(tot))
        fractions.append(F.max(pos(F.col("_tot")) - F.floor(pos(F.col("_tot")))).alias(f"_{name}_f"))
        vlo, vhi = F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double")
        finals.append((vlo + (vhi - vlo) * F.col(f"_{name}_f")).alias(name))
    return _picked(df, groups, value, ranks, *fractions).select(*groups, *finals)


def percentile_disc(df: DataFrame, groups: Sequence[str], value: Column,
                    probs: dict[str, float], descending: bool = False) -> DataFrame:
    """Exact discrete percentiles: the first value whose cumulative share
    reaches p, in ascending (or descending) order. Output keeps the input type."""
    def rank(tot: Column, p: float) -> Column:
        # ascending: 0-based rank ceil(p * n) - 1 (at least 0)
        k = F.greatest(F.ceil(tot.cast("double") * float(p)) - 1, F.lit(0))
        return tot - 1 - k if descending else k

    return _picked(df, groups, value, {n: lambda tot, p=p: rank(tot, p) for n, p in probs.items()})


def upper_median(df: DataFrame, groups: Sequence[str], value: Column,
                 name: str = "median") -> DataFrame:
    """``sorted(values)[floor(n / 2)]``: the upper median for even counts
    (equal to ``percentile_disc(0.5)`` over a descending order)."""
    return _picked(df, groups, value, {name: lambda tot: F.floor(tot / 2)})
