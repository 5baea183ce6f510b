"""Running totals over a per-request timeline that hold up when requests are huge.

A window partitioned by the request puts each request's whole timeline in one
task. That is right for almost every request and hopeless for one that owns a
third of the rows. ``split_hot_keys`` sets apart the rows of such requests, and only
those, and deals them out by range of (request, order), so that consecutive parts of
a timeline become consecutive tiles of about equal size, whatever its values are.
``running`` works tile by tile and adds to each tile what the tiles before it hold.
Those totals are summed up as a tree: over FAN tiles, over FAN blocks of tiles, and
so on, so that no window ever spans a whole long timeline. The result is the same as
that of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.counters import or_zero
from ..session import frozen

# A request up to this many rows is sorted in one task without trouble; so is a tile.
HOT_ROWS = 5_000_000
# Tiles, or blocks of them, whose totals one window adds up.
FAN = 1024
# Rows of keys and totals up to which a table is broadcast by hint; beyond it Spark decides.
BROADCAST_ROWS = 100_000

TILE = "_tile"


@dataclass(frozen=True)
class Split:
    """``plain`` rows of requests that fit a task; ``hot`` rows of the others with their tile (None: no such request)."""

    plain: DataFrame
    hot: DataFrame | None
    tiles: int


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equal in all columns, null to null; the right side's are prefixed."""
    return reduce(lambda a, b: a & b, [left[name].eqNullSafe(right[f"_of_{name}"]) for name in names])


def _prefixed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: f"_of_{name}" for name in names})


def split_hot_keys(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> Split:
    """Set apart requests of more than ``hot_rows`` rows and cut their timelines into tiles of about that size.

    ``order_by`` orders the rows of a request without ties; any sortable types will do,
    and nulls come first. Tile numbers rise along the timeline. There are as many
    tiles as the rows of all hot requests fill, however many requests that are.
    ``hot_rows=None`` skips the search for hot requests.
    """
    if hot_rows is None:
        return Split(df, None, 0)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    large = frozen(sizes, "hot-requests")
    requests, total = large.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not requests:
        return Split(df, None, 0)
    marks = _small(_prefixed(large.select(*keys), keys), requests)
    same = _same(df, marks, keys)
    tiles = -(-total // hot_rows)
    dealt = df.join(marks, same, "left_semi").repartitionByRange(tiles, *keys, *order_by)
    # Written, because ranges come from a sample that another evaluation might draw differently.
    hot = frozen(dealt.withColumn(TILE, F.spark_partition_id()), "hot-timelines")
    return Split(df.join(marks, same, "left_anti"), hot, tiles)


def _before(
    totals: DataFrame, keys: Sequence[str], place: str, sums: Sequence[str], lasts: Sequence[str], places: int
) -> DataFrame:
    """Per request and place: what the request's smaller places add up to and leave behind.

    Places are added up within blocks of FAN; what the blocks before hold is found in the
    same way, from one row for each request and block.
    """
    block = f"{place}_block"
    blocked = totals.withColumn(block, F.floor(F.col(place) / FAN))
    earlier = Window.partitionBy(*keys, block).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.select(
        *keys,
        place,
        block,
        *[F.sum(name).over(earlier).alias(name) for name in sums],
        *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in lasts],
    )
    if places <= FAN:
        return local.drop(block)
    blocks = blocked.groupBy(*keys, block).agg(
        *[F.sum(name).alias(name) for name in sums],
        *[F.max_by(name, F.when(F.col(name).isNotNull(), F.col(place))).alias(name) for name in lasts],
    )
    above = _prefixed(
        _before(blocks, keys, block, sums, lasts, -(-places // FAN)), [*keys, block, *sums, *lasts]
    )
    return local.join(above, _same(local, above, [*keys, block]), "left").select(
        *[local[name] for name in (*keys, place)],
        *[(or_zero(F.col(name)) + or_zero(F.col(f"_of_{name}"))).alias(name) for name in sums],
        *[F.coalesce(name, f"_of_{name}").alias(name) for name in lasts],
    )


def _carried(
    split: Split, keys: Sequence[str], order_by: Sequence[str], sums: Mapping[str, Column], lasts: Mapping[str, Column]
) -> DataFrame:
    """What the tiles before each tile of a hot timeline hold, as prefixed columns.

    A row for each tile and request in it: at most the number of tiles plus that of hot requests.
    """
    moment = F.struct(*order_by)
    totals = frozen(
        split.hot.groupBy(*keys, TILE).agg(
            *[F.sum(column).alias(name) for name, column in sums.items()],
            *[F.max_by(column, F.when(column.isNotNull(), moment)).alias(name) for name, column in lasts.items()],
        ),
        "hot-totals",
    )
    before = _before(totals, keys, TILE, list(sums), list(lasts), split.tiles)
    return _small(_prefixed(before, [*keys, TILE, *sums, *lasts]), totals.count())


def running(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    sums: Mapping[str, Column],
    lasts: Mapping[str, Column] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add running sums and last-seen values along each request's timeline, current row included.

    ``sums`` maps a new column to the bigint to add up, ``lasts`` maps a new column to
    the expression whose latest non-null value to carry. ``order_by`` must order the
    rows of a request without ties.
    """
    lasts = lasts or {}

    def along(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        so_far = Window.partitionBy(*groups).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumns(
            {
                **{name: F.sum(column).over(so_far) for name, column in sums.items()},
                **{name: F.last(column, ignorenulls=True).over(so_far) for name, column in lasts.items()},
            }
        )

    split = split_hot_keys(df, keys, order_by, hot_rows)
    plain = along(split.plain, keys)
    if split.hot is None:
        return plain
    local = along(split.hot, [*keys, TILE])
    carried = _carried(split, keys, order_by, sums, lasts)
    hot = local.join(carried, _same(local, carried, [*keys, TILE]), "left").select(
        *df.columns,
        *[(F.col(name) + or_zero(F.col(f"_of_{name}"))).alias(name) for name in sums],
        *[F.coalesce(name, f"_of_{name}").alias(name) for name in lasts],
    )
    return plain.unionByName(hot)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    name: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the value (never null) that the row before had on the same request's timeline."""

    def along(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        return rows.withColumn(name, F.lag(value).over(Window.partitionBy(*groups).orderBy(*order_by)))

    split = split_hot_keys(df, keys, order_by, hot_rows)
    plain = along(split.plain, keys)
    if split.hot is None:
        return plain
    local = along(split.hot, [*keys, TILE])
    carried = _carried(split, keys, order_by, {}, {name: F.col(value)})
    hot = local.join(carried, _same(local, carried, [*keys, TILE]), "left").select(
        *df.columns, F.coalesce(name, f"_of_{name}").alias(name)
    )
    return plain.unionByName(hot)
