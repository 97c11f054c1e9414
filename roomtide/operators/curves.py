"""Booking, cancellation and pickup curves over any dimensions.

A curve has one row per (dims, live_dt, adv_days). All input rows are summed
to that key with map-side partial sums before anything is windowed, so a
window partition holds at most one row per distinct advance day of one stay
date, however many bookings lie behind it.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from roomtide.functions import advance_days
from roomtide.session import dealt

MEASURES = ["rns", "rev"]
KINDS = ["booked", "valid", "gone"]


def _folded(event_dt: str) -> Column:
    """Advance day of an event; everything after the stay date counts as day 0."""
    return F.greatest(advance_days("live_dt", event_dt), F.lit(0))


def advance_totals(area: DataFrame, dims: list[str], event_dt: str = "order_dt") -> DataFrame:
    """Sums per signed advance day, before folding and gap filling."""
    return area.groupBy(*dims, "live_dt", advance_days("live_dt", event_dt).alias("adv_days")).agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )


def _dated(area: DataFrame, event_dt: str) -> DataFrame:
    """Rows that can be placed on a curve at all."""
    return area.where(F.col("live_dt").isNotNull() & F.col(event_dt).isNotNull())


def _sparse(area: DataFrame, dims: list[str], event_dt: str) -> DataFrame:
    return _dated(area, event_dt).groupBy(*dims, "live_dt", _folded(event_dt).alias("adv_days")).agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )


def _by_day_desc(dims: list[str]):
    return Window.partitionBy(*dims, "live_dt").orderBy(F.col("adv_days").desc())


def _fill_gaps(sparse: DataFrame, dims: list[str], fillers: dict[str, Column]) -> DataFrame:
    """Add the advance days missing between the smallest and largest one.

    Each row knows the next larger day present and emits itself plus the
    days up to it. ``fillers`` gives the values of the added days, for each
    column that stays.
    """
    w = _by_day_desc(dims)
    larger = F.lag("adv_days").over(w)
    marked = sparse.select(
        *dims, "live_dt", "adv_days", *fillers,
        *[filler.alias(f"fill_{m}") for m, filler in fillers.items()],
        F.coalesce(larger - 1, F.col("adv_days")).alias("last_day"),
    )
    own = F.col("day") == F.col("adv_days")
    return marked.select(
        "*", F.explode_outer(F.sequence("adv_days", "last_day")).alias("day")
    ).select(
        *dims, "live_dt", F.col("day").alias("adv_days"),
        *[F.when(own, F.col(m)).otherwise(F.col(f"fill_{m}")).alias(m) for m in fillers],
    )


def densify(sparse: DataFrame, dims: list[str]) -> DataFrame:
    """Fill the gaps of a summed curve with zero rows."""
    return _fill_gaps(sparse, dims, {m: F.lit(0.0) for m in MEASURES})


def densify_cumulative(sparse: DataFrame, dims: list[str]) -> DataFrame:
    """``cumulative(densify(sparse))`` in one window pass.

    An added day has nothing of its own, so its running total is the one of
    the next larger day present.
    """
    w = _by_day_desc(dims).rowsBetween(Window.unboundedPreceding, 0)
    running = sparse.select(
        *dims, "live_dt", "adv_days",
        *[F.sum(m).over(w).alias(m) for m in MEASURES],
    )
    before = _by_day_desc(dims)
    return _fill_gaps(running, dims, {m: F.lag(m).over(before) for m in MEASURES})


def densify_both(sparse: DataFrame, dims: list[str]) -> DataFrame:
    """``densify`` and, as ``acc_rns`` and ``acc_rev``, ``densify_cumulative``, in one window pass."""
    w = _by_day_desc(dims).rowsBetween(Window.unboundedPreceding, 0)
    running = sparse.select(
        *dims, "live_dt", "adv_days", *MEASURES, *[F.sum(m).over(w).alias(f"acc_{m}") for m in MEASURES]
    )
    before = _by_day_desc(dims)
    fillers = {m: F.lit(0.0) for m in MEASURES} | {f"acc_{m}": F.lag(f"acc_{m}").over(before) for m in MEASURES}
    return _fill_gaps(running, dims, fillers)


def booking_curve(area: DataFrame, dims: list[str]) -> DataFrame:
    """All orders, later cancelled ones included, by days from order to stay."""
    return densify(_sparse(area, dims, "order_dt"), dims)


def _valid_sparse(area: DataFrame, dims: list[str]) -> DataFrame:
    return _sparse(area.where(F.col("cancel_dt").isNull()), dims, "order_dt")


def _cancel_sparse(area: DataFrame, dims: list[str]) -> DataFrame:
    return _sparse(area, dims, "cancel_dt")


def valid_curve(area: DataFrame, dims: list[str]) -> DataFrame:
    """Orders never cancelled, by days from order to stay."""
    return densify(_valid_sparse(area, dims), dims)


def cancel_curve(area: DataFrame, dims: list[str]) -> DataFrame:
    """Cancelled orders, by days from cancellation to stay."""
    return densify(_cancel_sparse(area, dims), dims)


def net_curve(booked: DataFrame, cancelled: DataFrame, dims: list[str]) -> DataFrame:
    """Booked minus cancelled for two finished curves.

    Cancel days the booking curve does not have are left out, and a cancel
    key given twice gives two rows. An unknown (NULL) dimension matches itself.
    """
    keys = [*dims, "live_dt", "adv_days"]
    gone = cancelled.select(*[F.col(c).alias(f"gone_{c}") for c in [*keys, *MEASURES]])
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"gone_{k}")) for k in keys])
    return booked.join(gone, same_key, "left").select(
        *keys,
        *[(F.col(m) - F.coalesce(f"gone_{m}", F.lit(0.0))).alias(m) for m in MEASURES],
    )


def _events(area: DataFrame) -> DataFrame:
    """One row per booking and one more per cancellation, placed on their advance day.

    ``booked``, ``valid`` and ``gone`` are structs of measures, NULL where
    the event is of another kind.
    """
    def event(event_dt: str, booked: bool) -> Column:
        own = F.struct(*[F.col(m) for m in MEASURES])
        never = F.when(F.lit(False), own)
        return F.struct(
            _folded(event_dt).alias("adv_days"),
            (own if booked else never).alias("booked"),
            (F.when(F.col("cancel_dt").isNull(), own) if booked else never).alias("valid"),
            (never if booked else own).alias("gone"),
        )

    order, cancel = event("order_dt", True), event("cancel_dt", False)
    rows = _dated(area, "order_dt")
    others = [c for c in rows.columns if c not in MEASURES]
    return rows.select(
        *others,
        F.explode_outer(
            F.when(F.col("cancel_dt").isNull(), F.array(order)).otherwise(F.array(order, cancel))
        ).alias("event"),
    ).select(*others, "event.*")


def event_sums(area: DataFrame, pairs: dict[str, list[str]]) -> DataFrame:
    """Booked, valid and cancelled sums per advance day for several dimension pairs at once.

    The area rows are read a single time for all pairs. ``pair`` names the
    set a row belongs to; the dimensions of other pairs are NULL. Every set
    has stay date and advance day, so events are dealt once by these, as
    narrow rows, and all sets are summed behind that exchange: neither their
    copies for each pair nor the wide sums move. The partitions are not
    merged, for their rows grow.
    """
    dims = sorted({d for pair in pairs.values() for d in pair})
    days = ["live_dt", "adv_days"]
    events = _events(area.select(*dims, "live_dt", "order_dt", "cancel_dt", *MEASURES))
    kind = F.when(F.col("gone").isNotNull(), 2).when(F.col("valid").isNotNull(), 0).otherwise(1)
    own = F.coalesce("booked", "gone")
    narrow = events.select(*dims, *days, kind.cast("tinyint").alias("kind"), *[own[m].alias(m) for m in MEASURES])
    none = {d: F.lit(None).cast(area.schema[d].dataType) for d in dims}
    sets = F.array(*[
        F.struct(F.lit(name).alias("pair"), *[(F.col(d) if d in pair else none[d]).alias(d) for d in dims]) for name, pair in pairs.items()
    ])
    of_sets = narrow.repartition(dealt(area.sparkSession), *days).select(*days, "kind", *MEASURES, F.explode(sets).alias("set")).select(*days, "kind", *MEASURES, "set.*")
    sums = []
    for name, chosen in {"booked": F.col("kind") < 2, "valid": F.col("kind") == 0, "gone": F.col("kind") == 2}.items():
        sums.append(F.bool_or(chosen).alias(name))
        sums += [F.coalesce(F.sum(F.when(chosen, F.col(m))), F.lit(0.0)).alias(f"{name}_{m}") for m in MEASURES]
    return of_sets.groupBy("pair", *dims, *days).agg(*sums).select(*dims, *days, *[f"{k}{m}" for k in KINDS for m in ("", *(f"_{x}" for x in MEASURES))], "pair")


def valid_part(sums: DataFrame, dims: list[str]) -> DataFrame:
    """The summed valid curve out of event sums."""
    return sums.where("valid").select(
        *dims, "live_dt", "adv_days", *[F.col(f"valid_{m}").alias(m) for m in MEASURES]
    )


def cancel_part(sums: DataFrame, dims: list[str]) -> DataFrame:
    """The summed cancel curve out of event sums."""
    return sums.where("gone").select(
        *dims, "live_dt", "adv_days", *[F.col(f"gone_{m}").alias(m) for m in MEASURES]
    )


def _within_bookings(net: DataFrame, dims: list[str]) -> DataFrame:
    """Net sums on the days of the booking curve that carry any event.

    Days outside the booking curve of their stay date are dropped, as
    ``net_curve`` does.
    """
    whole = _by_day_desc(dims).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    booked_day = F.when(F.col("booked"), F.col("adv_days"))
    return (
        net.withColumns(
            {"first_day": F.min(booked_day).over(whole), "last_day": F.max(booked_day).over(whole)}
        )
        .where(F.col("adv_days").between(F.col("first_day"), F.col("last_day")))
        .select(*dims, "live_dt", "adv_days", *MEASURES)
    )


def pickup_part(sums: DataFrame, dims: list[str]) -> DataFrame:
    """The summed pickup curve, booked minus cancelled, out of event sums."""
    net = [(F.col(f"booked_{m}") - F.col(f"gone_{m}")).alias(m) for m in MEASURES]
    return _within_bookings(sums.select(*dims, "live_dt", "adv_days", "booked", *net), dims)


def _pickup_sparse(area: DataFrame, dims: list[str]) -> DataFrame:
    """Bookings and cancellations netted in one aggregation: one read, no join of curves."""
    net = [F.sum(F.coalesce(f"booked.{m}", -F.col(f"gone.{m}"))).alias(m) for m in MEASURES]
    sums = _events(area).groupBy(*dims, "live_dt", "adv_days").agg(
        F.bool_or(F.col("booked").isNotNull()).alias("booked"), *net
    )
    return _within_bookings(sums, dims)


def pickup_curve(area: DataFrame, dims: list[str]) -> DataFrame:
    """Booking curve minus cancel curve, from one pass over the area rows."""
    return densify(_pickup_sparse(area, dims), dims)


def cumulative(curve: DataFrame, dims: list[str]) -> DataFrame:
    """Running totals from the largest advance day down, one row per input row.

    Rows sharing an advance day stay separate; revenue and room nights order
    them, so the result does not depend on how the input is partitioned.
    """
    w = (
        Window.partitionBy(*dims, "live_dt")
        .orderBy(F.col("adv_days").desc(), F.col("rns").desc(), F.col("rev").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return curve.select(
        *dims, "live_dt", "adv_days", *[F.sum(m).over(w).alias(m) for m in MEASURES]
    )


def valid_cumulative(area: DataFrame, dims: list[str]) -> DataFrame:
    return densify_cumulative(_valid_sparse(area, dims), dims)


def cancel_cumulative(area: DataFrame, dims: list[str]) -> DataFrame:
    return densify_cumulative(_cancel_sparse(area, dims), dims)


def pickup_cumulative(area: DataFrame, dims: list[str]) -> DataFrame:
    return densify_cumulative(_pickup_sparse(area, dims), dims)


def curve_rows(curve: DataFrame, dims: list[str]) -> DataFrame:
    """The text-file layout of a curve, with its empty ``remark`` column."""
    return curve.select(*dims, F.lit("").alias("remark"), "live_dt", "adv_days", *MEASURES)
