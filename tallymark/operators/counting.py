"""Counting records per request and reading what a control message declared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import counters as C, messages as M, statistics as S


def with_message_key(df: DataFrame, number: str | Column, office_number: str | Column | None = None) -> DataFrame:
    """Add the two-column request key rendered from a number.

    Rendering is one-to-one, so an aggregation can run on the compact number and
    render the text key only on its result.
    """
    request = F.col(number) if isinstance(number, str) else number
    office = request if office_number is None else office_number
    office = F.col(office) if isinstance(office, str) else office
    return df.withColumns({"req_id": M.request_id(request), "fo_id": M.office_id(office)})


def to_data_messages(
    df: DataFrame,
    *,
    keys: Sequence[str] = M.KEYS,
    number: Column,
    value: Column,
    type: Column,
    ts: Column | None = None,
    extra: Sequence[str] = (),
    types: Sequence[str] | None = M.TYPES,
) -> DataFrame:
    """Shape any table as data messages: key, type, id, value text, and time where there is one.

    ``types=None`` says that ``type`` already holds nothing but known names and
    UNRECOGNIZED, which spares every row the check.
    """
    columns = [
        *keys,
        (type if types is None else M.normalise_type(type, types)).alias("type"),
        M.record_id(number).alias("id"),
        M.text_or_empty(value.cast("string")).alias("value"),
    ]
    if ts is not None:
        columns.append(ts.alias("ts"))
    return df.select(*columns, *extra)


def type_counts(data: DataFrame, keys: Sequence[str] = M.KEYS, types: Sequence[str] = M.TYPES) -> DataFrame:
    """Received records per request and type; a record of another type counts as zero.

    One hash aggregation with map-side partial counts, so the shuffle carries one
    row per request and input partition however many records a request has.
    """
    return data.groupBy(*keys).agg(
        *[C.count_of_type(F.col("type"), t).alias(M.received_column(t)) for t in types]
    )


def control_totals(
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str | None = None,
) -> DataFrame:
    """Control message body each request should announce: a map holding a count for every type.

    With ``ts`` the announcement also gets the time of the request's first record.
    """
    counts = {t: C.count_of_type(F.col("type"), t).alias(M.received_column(t)) for t in types}
    first = [] if ts is None else [F.min(ts).alias(ts)]
    statistics = S.build_statistics({t: F.col(M.received_column(t)) for t in types})
    return (
        data.groupBy(*keys)
        .agg(*counts.values(), *first)
        .select(*keys, statistics.alias("statistics"), *([] if ts is None else [ts]))
    )


def explode_statistics(control: DataFrame, keys: Sequence[str] = M.KEYS) -> DataFrame:
    """One row per request and declared type."""
    return control.select(*keys, F.explode("statistics").alias("type", "declared"))


def declared_counts(
    control: DataFrame,
    types: Sequence[str] = M.TYPES,
    missing: str = "zero",
) -> DataFrame:
    """Replace the statistics map by one declared column per type.

    ``missing`` says what a map without one of the types means: ``zero`` reads it
    as 0, ``fail`` fails the query, ``quarantine`` leaves the count null and names
    the missing types in ``error``.
    """
    statistics = F.col("statistics")
    if missing == "zero":
        read = {t: S.statistic_or_default(statistics, t) for t in types}
    elif missing == "fail":
        read = {t: S.statistic_or_fail(statistics, t) for t in types}
    elif missing == "quarantine":
        read = {t: S.statistic(statistics, t) for t in types}
    else:
        raise ValueError(f"missing must be zero, fail or quarantine, not {missing!r}")
    columns = {M.declared_column(t): column for t, column in read.items()}
    if missing == "quarantine":
        absent = F.filter(
            F.array(*[F.when(column.isNull(), F.lit(t)) for t, column in read.items()]),
            lambda name: name.isNotNull(),
        )
        reason = F.when(F.size(absent) > 0, F.concat(F.lit("MISSING_TYPE:"), F.array_join(absent, ",")))
        earlier = F.col("error") if "error" in control.columns else F.lit(None).cast("string")
        columns["error"] = F.coalesce(earlier, reason)
    return control.withColumns(columns).drop("statistics")


def control_profile(control: DataFrame, types: Sequence[str] = M.TYPES) -> DataFrame:
    """Per control message: number of declared types and which of the known ones are present."""
    statistics = S.statistics_or_empty(F.col("statistics"))
    return control.withColumns(
        {
            "n_types": S.statistics_size(F.col("statistics")),
            **{f"has_{M.slug(t)}": S.has_statistic(statistics, t) for t in types},
        }
    )


def merge_control(
    base: DataFrame,
    update: DataFrame,
    keys: Sequence[str] = M.KEYS,
    remove: Sequence[str] = (),
) -> DataFrame:
    """Merge two control frames request by request, field by field.

    A non-empty name in ``update`` replaces the base's, the maps unite with the
    update's counts winning, and types named in ``remove`` are taken out. ``ts`` and
    ``seq``, where a frame has them, are the update's, else the base's. Both frames
    hold one row per request (see ``latest_control``).
    """
    order = [c for c in ("ts", "seq") if c in base.columns or c in update.columns]

    def side(df: DataFrame, age: str) -> DataFrame:
        held = [F.col(c).alias(f"_{age}_{c}") for c in order if c in df.columns]
        return df.select(*keys, F.col("fo_name").alias(f"_{age}_name"), F.col("statistics").alias(f"_{age}"), *held)

    left, right = side(base, "old"), side(update, "new")
    name = F.coalesce(F.nullif(F.col("_new_name"), F.lit("")), F.col("_old_name"), F.lit(""))
    statistics = S.merge_statistics(F.col("_old"), F.col("_new"))
    if remove:
        statistics = S.remove_statistics(statistics, *remove)
    joined = left.join(right, list(keys), "full_outer")
    newer = [
        F.coalesce(*[F.col(c) for c in (f"_new_{c}", f"_old_{c}") if c in joined.columns]).alias(c) for c in order
    ]
    return joined.select(*keys, name.alias("fo_name"), statistics.alias("statistics"), *newer)


def describe_counts(counts: DataFrame, trades: str, market: str, name: str = "description") -> DataFrame:
    """Add the text form of a pair of count columns."""
    return counts.withColumn(name, C.describe(F.col(trades), F.col(market)))
