"""Column functions over a control message's ``statistics`` map.

All of them work without touching ``spark.sql.mapKeyDedupPolicy``: a put or a
merge goes through ``map_zip_with``, which unites the keys of both sides.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

MAP_TYPE = "map<string,bigint>"


def empty_statistics() -> Column:
    return F.create_map().cast(MAP_TYPE)


def statistics_or_empty(statistics: Column) -> Column:
    """An unset map reads as an empty map."""
    return F.coalesce(statistics.cast(MAP_TYPE), empty_statistics())


def build_statistics(counts: Mapping[str, Column]) -> Column:
    """Map of type name to count, one entry per given type."""
    parts = [part for name, count in counts.items() for part in (F.lit(name), count.cast("bigint"))]
    return F.create_map(*parts).cast(MAP_TYPE)


def statistic(statistics: Column, type_name: str) -> Column:
    """Count declared for a type, null when the type is missing."""
    return statistics.getItem(type_name)


def statistic_or_default(statistics: Column, type_name: str, default: int = 0) -> Column:
    return F.coalesce(statistic(statistics, type_name), F.lit(default).cast("bigint"))


def statistic_or_fail(statistics: Column, type_name: str) -> Column:
    """Count declared for a type; the query fails when the type is missing."""
    return F.coalesce(
        statistic(statistics, type_name),
        F.raise_error(F.lit(f"statistics has no entry for {type_name}")).cast("bigint"),
    )


def has_statistic(statistics: Column, type_name: str) -> Column:
    return F.map_contains_key(statistics, type_name)


def statistics_size(statistics: Column) -> Column:
    return F.size(statistics_or_empty(statistics)).cast("bigint")


def merge_statistics(old: Column, new: Column) -> Column:
    """Union of both maps; where both have a key the new value wins."""
    return F.map_zip_with(
        statistics_or_empty(old), statistics_or_empty(new), lambda _, before, after: F.coalesce(after, before)
    )


def put_statistics(statistics: Column, counts: Mapping[str, Column]) -> Column:
    return merge_statistics(statistics, build_statistics(counts))


def remove_statistics(statistics: Column, *type_names: str) -> Column:
    return F.map_filter(statistics_or_empty(statistics), lambda name, _: ~name.isin(*type_names))


def last_entry_wins(statistics: Column) -> Column:
    """Resolve repeated keys, as JSON text can hold them: the last entry wins."""
    names = F.array_distinct(F.map_keys(statistics))
    latest = F.transform(
        names,
        lambda name: F.element_at(
            F.filter(F.map_entries(statistics), lambda entry: entry["key"] == name), -1
        )["value"],
    )
    repeated = F.size(names) < F.size(F.map_keys(statistics))
    return F.when(repeated, F.map_from_arrays(names, latest)).otherwise(statistics)
