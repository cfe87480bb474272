"""Stored roll-ups: groupings of a flat view that answer questions without reading its rows again.

Each grouping is a table of one row per combination of its columns, with parts that add up: the row count, and for every
measure its sum, number of values, least and largest value, and on request a quantile sketch.  A grouping is made from
the smallest stored one that holds its columns and sketches, so the flat view is read only for groupings that no other
one covers.  A question is answered from the smallest grouping that holds its columns, in any direction of drilling.

Sums and counts are exact.  Quantiles come from KLL sketches, which merge along any column: with chance 0.99 the rank of
an answer is within `rank_error` of the rank asked for, however the values are distributed.  The sketch draws at random,
so quantiles may differ between runs within that bound; exact quantiles are in `functions.ranks`.

Missing column values form groups of their own; missing measure values count in no part but the row count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.olap import filter_in_lists

ROWS = "row_count"
SKETCH_SIZE = 800


@dataclass(frozen=True)
class Wanted:
    """Columns of a grouping, and the measures whose quantiles it keeps."""

    columns: tuple[str, ...]
    sketches: tuple[str, ...] = ()


@dataclass(frozen=True)
class Grouping:
    """A stored grouping: its table, its number of rows, and the grouping it was made from (None: the flat view)."""

    wanted: Wanted
    table: DataFrame
    rows: int
    source: str | None


@dataclass(frozen=True)
class Rollups:
    """Stored groupings of one flat view by name, with the measures they all carry."""

    groupings: Mapping[str, Grouping]
    measures: tuple[str, ...]

    def holding(self, columns: Sequence[str], sketches: Sequence[str] = ()) -> str | None:
        """The smallest grouping with these columns and sketches; None if there is none."""
        able = [
            (grouping.rows, name)
            for name, grouping in self.groupings.items()
            if {*columns} <= {*grouping.wanted.columns} and {*sketches} <= {*grouping.wanted.sketches}
        ]
        return min(able)[1] if able else None


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Share of ranks that a sketched quantile is off by at most, with chance 0.99 (the published fit for KLL)."""
    return 2.296 / size**0.9723


def build_rollups(
    view: Callable[[tuple[str, ...]], DataFrame],
    wanted: Mapping[str, Wanted],
    measures: Sequence[str],
    path: str,
    earlier: Rollups | None = None,
    size: int = SKETCH_SIZE,
) -> Rollups:
    """Store the wanted groupings under `path`, finest first.

    `view` gives flat rows with (at least) the named columns and the measures, so joins a grouping has no use for are
    left out.  With `earlier` roll-ups of the same groupings, kept under another path, the view holds new rows only and
    their parts are added to the earlier ones.
    """
    done: dict[str, Grouping] = {}
    finest_first = sorted(wanted, key=lambda name: (-len(wanted[name].columns), -len(wanted[name].sketches), name))
    for name in finest_first:
        want = wanted[name]
        source = Rollups(done, tuple(measures)).holding(want.columns, want.sketches)
        if source:
            frame = _merged(done[source].table, want, measures)
        else:
            frame = _counted(view(want.columns), want, measures, size)
            if earlier:
                frame = _merged(earlier.groupings[name].table.unionByName(frame), want, measures)
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
        table = frame.sparkSession.read.parquet(f"{path}/{name}")
        done[name] = Grouping(want, table, table.count(), source)
    return Rollups({name: done[name] for name in wanted}, tuple(measures))


def _counted(flat: DataFrame, want: Wanted, measures: Sequence[str], size: int) -> DataFrame:
    """Parts of flat rows."""
    parts = [F.count("*").alias(ROWS)]
    for m in measures:
        parts += [F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_count"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    for m in want.sketches:
        parts.append(F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(size)).alias(f"{m}_sketch"))
    return flat.groupBy(*want.columns).agg(*parts)


def _merged(table: DataFrame, want: Wanted, measures: Sequence[str]) -> DataFrame:
    """Parts of parts, in the types of the stored ones."""
    parts = [F.sum(ROWS).alias(ROWS)]
    for m in measures:
        kept = table.schema[f"{m}_sum"].dataType
        parts += [F.sum(f"{m}_sum").cast(kept).alias(f"{m}_sum"), F.sum(f"{m}_count").alias(f"{m}_count")]
        parts += [F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    for m in want.sketches:
        parts.append(F.kll_merge_agg_double(f"{m}_sketch").alias(f"{m}_sketch"))
    return table.groupBy(*want.columns).agg(*parts)


def _table(rollups: Rollups, columns: Sequence[str], sketches: Sequence[str] = ()) -> DataFrame:
    name = rollups.holding(columns, sketches)
    if name is None:
        raise ValueError(f"no stored grouping holds {sorted({*columns})} with sketches of {sorted({*sketches})}")
    return rollups.groupings[name].table


def as_flat(rollups: Rollups, columns: Sequence[str]) -> DataFrame:
    """The smallest fitting grouping with sums under the names of their measures: what only sums (slices, drilling,
    pivots, hierarchies) takes it for the flat view.
    """
    table = _table(rollups, columns)
    return table.select(*columns, *[F.col(f"{m}_sum").alias(m) for m in rollups.measures])


def answer(
    rollups: Rollups,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    selections: Mapping[str, Sequence | None] | None = None,
    sketches: Sequence[str] = (),
) -> DataFrame:
    """Aggregates (`total`, `mean`, `quantile`, ...) by keys, over rows whose columns are in the selected lists.

    `sketches` names the measures whose quantiles are asked for.
    """
    chosen = {name: values for name, values in (selections or {}).items() if values is not None}
    table = filter_in_lists(_table(rollups, [*keys, *chosen], sketches), chosen)
    return table.groupBy(*keys).agg(*[aggregate.alias(name) for name, aggregate in aggregates.items()])


def lines() -> Column:
    """Number of flat rows."""
    return F.coalesce(F.sum(ROWS), F.lit(0))


def total(measure: str) -> Column:
    """Sum of a measure; NULL without values."""
    return F.sum(f"{measure}_sum")


def values(measure: str) -> Column:
    """Number of values of a measure."""
    return F.coalesce(F.sum(f"{measure}_count"), F.lit(0))


def mean(measure: str) -> Column:
    """Mean of a measure; NULL without values."""
    return F.try_divide(total(measure).cast("double"), values(measure).cast("double"))


def least(measure: str) -> Column:
    """Smallest value."""
    return F.min(f"{measure}_min")


def most(measure: str) -> Column:
    """Largest value."""
    return F.max(f"{measure}_max")


def quantile(measure: str, share: float) -> Column:
    """Value of about this share of the ranks, from the sketches; NULL without values."""
    sketch = F.kll_merge_agg_double(f"{measure}_sketch")
    return F.when(values(measure) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))
