"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalogue import starschema as star
from roomtide.functions import as_compact, as_dashed, parse_day
from roomtide.model import AREA_ORDERS, HOTEL_DICTIONARY, curve_layout
from roomtide.operators import area, backtest, curves, forecast, nights, reference, season
from roomtide.plans.curve_jobs import cumulative_curve, daily_curve, read_curve
from roomtide.plans.otb import run_daily
from roomtide.plans.reference_tables import reference_tables as all_tables
from roomtide.plans.seasons import season_runs, season_table, store_history
from roomtide.plans.sql_list import SqlStatement, run_statements
from roomtide.session import scratch_path
from roomtide.sources import (
    publish_version,
    read_delimited,
    read_lines,
    read_named_fields,
    read_parquet,
    read_snapshot,
    read_version,
    write_delimited,
    write_parquet,
    write_partitioned,
)

Query = Callable[[SparkSession, str], DataFrame]

MIN_LIVE_DT = date(1996, 1, 1)
BEFORE_ALL = date(1900, 1, 1)
TRAIN_START, TRAIN_END = date(1995, 1, 1), date(1996, 1, 12)
CALENDAR_START, CALENDAR_END = date(1996, 1, 1), date(1997, 12, 31)
WEEKS, SEASONS = 2, 5
AS_OF = date(2001, 7, 1)
# Fixed value: the mark that stands for the hotel's code in template lines.
TEMPLATE = ["V_HTL#1####1996-01-01#1996-06-30", "V_HTL#2####1996-07-01#1997-12-31"]


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Round doubles half up, so that the order of additions cannot show.

    Plain arithmetic: ``F.round`` goes through BigDecimal, which costs more
    than the queries themselves.
    """
    scale = F.lit(10.0**places)
    return df.select(
        *[
            (F.floor(F.col(f.name) * scale + 0.5) / scale).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _area_rows(spark: SparkSession, sf_dir: str, cancelled: bool | None = None) -> DataFrame:
    return area.area_nights(
        star.bookings(spark, sf_dir, cancelled), star.hotel_dictionary(spark, sf_dir), BEFORE_ALL
    )


# --- sources and sinks -------------------------------------------------------


def _area_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area.area_orders_from_bookings(star.bookings(spark, sf_dir), star.hotel_dictionary(spark, sf_dir), BEFORE_ALL)


def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "area-text")
    write_delimited(rounded(_area_totals(spark, sf_dir)).select(*AREA_ORDERS.names), path)
    return read_delimited(spark, path, AREA_ORDERS)


def scan_hotel_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dictionary")
    write_delimited(star.hotel_dictionary(spark, sf_dir), path, sep="\t")
    return read_delimited(spark, path, HOTEL_DICTIONARY, sep="\t").select(
        "hotel", "hotelname", "star", "city", "zone", "location", "masterhotelid", "updatetime"
    )


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )


def read_snapshot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by the last day of their month; the snapshot of the day before ``as_of``."""
    path = scratch_path(spark, "snapshots")
    orders = star.table(spark, sf_dir, "orders")
    dated = orders.withColumn("dt", as_compact(F.last_day(F.col("o_orderdate").cast("date"))))
    write_partitioned(dated, path, ["dt"])
    return read_snapshot(spark, path, "now", AS_OF).select("o_orderkey", "o_custkey", "o_totalprice")


def reference_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    lines = star.table(spark, sf_dir, "customer").select(
        F.explode(F.array(F.concat_ws("#", "c_custkey", "c_name"), F.lit(""))).alias("value")
    )
    lines.write.text(path)
    return read_lines(spark, path)


def overwritten_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target written twice holds the second content alone; building the first one anew touches nothing."""
    path = scratch_path(spark, "twice")
    write_delimited(star.table(spark, sf_dir, "part").select("p_partkey", "p_name"), path)
    write_delimited(star.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path)
    return read_named_fields(spark, path, ["custkey", "segment"])


def repartitioned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as three files."""
    path = scratch_path(spark, "three")
    write_delimited(star.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), path, partitions=3)
    rows = read_named_fields(spark, path, ["orderkey", "priority"])
    files = rows.select("_metadata.file_path").distinct().agg(F.count("*").cast("int").alias("n"))
    return rows.withColumn("files", files.scalar())


def roundtrip_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curve, its remark included, through the gzip text sink and back."""
    dims = star.DIM_PAIRS["city_star"]
    path = scratch_path(spark, "curve-text")
    curve = rounded(curves.valid_curve(_area_rows(spark, sf_dir, False), dims))
    write_delimited(curves.curve_rows(curve, dims), path, compression="gzip")
    return read_delimited(spark, path, curve_layout(dims))


def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hotel-nights")
    write_parquet(hotel_nights(spark, sf_dir), path)
    return read_parquet(spark, path)


def _stored_tables(spark: SparkSession, tables: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    publish_version(tables, path, "v1")
    return read_version(spark, path, "v1")


def publish_by_hotel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = reference.flag_lines(reference.segment_flags(star.market_segments(spark, sf_dir)), "htl_cd")
    return _stored_tables(spark, reference.publish_by_hotel(lines, star.hotels(spark, sf_dir), "v1", "is_predict"), "published")


def publish_shared_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per hotel beside one that all hotels share."""
    flags = reference.segment_flags(star.market_segments(spark, sf_dir))
    own = reference.publish_by_hotel(reference.predconf_rows(flags, "htl_cd"), star.hotels(spark, sf_dir), "v1", "predconf")
    return _stored_tables(spark, own.unionByName(reference.publish_shared(reference.flag_lines(flags), "v1", "is_predict")), "uploaded")


def reference_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of a version but the season table, which has its own query."""
    lines = star.hotels(spark, sf_dir).selectExpr("htl_cd", "concat(htl_cd, '#1') as line")
    tables = all_tables(
        "v1", star.hotels(spark, sf_dir), reference.segment_flags(star.market_segments(spark, sf_dir)),
        star.hotel_bar_map(spark, sf_dir), lines, star.inventory_fields(spark, sf_dir),
    )
    return _stored_tables(spark, tables, "tables")


def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date parsing and formatting over all order dates."""
    day = F.col("o_orderdate").cast("date")
    dashed, compact = as_dashed(day), as_compact(day)
    return star.table(spark, sf_dir, "orders").select(
        "o_orderkey", dashed.alias("dashed"), compact.alias("compact"),
        F.datediff(parse_day(as_dashed(F.date_add(day, F.day(day)))), parse_day(compact.cast("string"))).alias("apart"),
    )


# --- bookings ----------------------------------------------------------------


def stay_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(nights.stay_nights(star.bookings(spark, sf_dir)))


def hotel_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        nights.hotel_nights(star.bookings(spark, sf_dir), star.hotel_dictionary(spark, sf_dir))
    )


def area_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        area.area_orders_from_bookings(
            star.bookings(spark, sf_dir), star.hotel_dictionary(spark, sf_dir), MIN_LIVE_DT
        )
    )


def area_orders_from_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two jobs one after the other: hotel nights, then area totals."""
    dictionary = star.hotel_dictionary(spark, sf_dir)
    per_hotel = nights.hotel_nights(star.bookings(spark, sf_dir), dictionary)
    return rounded(area.area_orders(per_hotel, dictionary, MIN_LIVE_DT))


def area_orders_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dictionary row of a shared master counts."""
    return rounded(
        area.area_orders_from_bookings(
            star.bookings(spark, sf_dir), star.hotel_dictionary(spark, sf_dir), MIN_LIVE_DT, dedupe=False
        )
    )


def event_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums behind all curves of all dimension pairs, from one pass."""
    return rounded(curves.event_sums(_area_rows(spark, sf_dir), star.DIM_PAIRS))


def _curve_query(curve: Callable, dims: list[str], cancelled: bool | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(curve(_area_rows(spark, sf_dir, cancelled), dims))

    return run


def _net_query(dims: list[str]) -> Query:
    """Pickup by joining a finished booking curve with a finished cancel curve, both of the stored area totals."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "area")
        write_parquet(_area_totals(spark, sf_dir), path)
        area_rows = read_parquet(spark, path)
        return rounded(curves.net_curve(curves.booking_curve(area_rows, dims), curves.cancel_curve(area_rows, dims), dims))

    return run


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 curves of the daily job, read back from its text files and added up by stay date."""
    root = scratch_path(spark, "daily")
    paths = run_daily(spark, star.bookings(spark, sf_dir), star.hotel_dictionary(spark, sf_dir), root, "now", AS_OF, BEFORE_ALL, partitions=4)
    parts = []
    for pair, dims in star.DIM_PAIRS.items():
        for name in [f"{m}_{pair}{acc}" for m in ("cancel", "valid", "pickup") for acc in ("", "_acc")]:
            curve = read_curve(spark, paths[name], dims)
            parts.append(
                curve.groupBy(F.lit(name).alias("curve"), F.col(dims[0]).alias("dim1"), F.col(dims[1]).alias("dim2"), "live_dt")
                .agg(F.count("*").alias("days"), F.max("adv_days").alias("last_day"), F.sum("rns").alias("rns"), F.sum("rev").alias("rev"))
            )
    return rounded(reduce(DataFrame.unionByName, parts))


def file_to_file_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area text to cancel, pickup and cumulative pickup, each job reading the files of those before; all are gzip files."""
    root, dims = scratch_path(spark, "jobs"), star.DIM_PAIRS["zone_star"]
    write_delimited(_area_totals(spark, sf_dir).select(*AREA_ORDERS.names), f"{root}/area", compression="gzip")
    daily_curve(spark, "cancel", dims, f"{root}/area", f"{root}/cancel", compression="gzip")
    daily_curve(spark, "pickup", dims, f"{root}/area", f"{root}/pickup", cancel_dir=f"{root}/cancel", compression="gzip")
    cumulative_curve(spark, dims, f"{root}/pickup", f"{root}/acc", compression="gzip")
    return rounded(read_curve(spark, f"{root}/acc", dims))


def _rerun_query(dims: list[str]) -> Query:
    """Running totals over a finished curve, as a separate step."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(curves.cumulative(curves.valid_curve(_area_rows(spark, sf_dir, False), dims), dims))

    return run


def _curve_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for pair, dims in star.DIM_PAIRS.items():
        out[f"advance_totals_{pair}"] = _curve_query(curves.advance_totals, dims, None)
        out[f"densify_{pair}"] = _curve_query(curves.booking_curve, dims, None)
        out[f"cancel_{pair}"] = _curve_query(curves.cancel_curve, dims, True)
        out[f"valid_{pair}"] = _curve_query(curves.valid_curve, dims, False)
        out[f"pickup_{pair}"] = _curve_query(curves.pickup_curve, dims, None)
        out[f"pickup_joined_{pair}"] = _net_query(dims)
        out[f"cancel_{pair}_acc"] = _curve_query(curves.cancel_cumulative, dims, True)
        out[f"valid_{pair}_acc"] = _curve_query(curves.valid_cumulative, dims, False)
        out[f"pickup_{pair}_acc"] = _curve_query(curves.pickup_cumulative, dims, None)
    out["cumulative_city_star"] = _rerun_query(star.DIM_PAIRS["city_star"])
    return out


# --- seasons and reference tables --------------------------------------------


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.segment_flags(star.market_segments(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> season.History:
    return store_history(star.segment_daily(spark, sf_dir), scratch_path(spark, "history"))


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season.weekly_mean(_history(spark, sf_dir), _flags(spark, sf_dir), TRAIN_START, TRAIN_END, WEEKS)


def season_weekly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weekly(spark, sf_dir))


def season_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season.bands(_weekly(spark, sf_dir), SEASONS).select("htl_cd", "bucket", "season_id")


def season_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season.calendar(
        season.bands(_weekly(spark, sf_dir), SEASONS), CALENDAR_START, CALENDAR_END, WEEKS
    )


def season_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season_runs(
        _history(spark, sf_dir), _flags(spark, sf_dir), TRAIN_START, TRAIN_END,
        CALENDAR_START, CALENDAR_END, WEEKS, SEASONS,
    )


def season_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = season.short_history_hotels(_history(spark, sf_dir), TRAIN_START, TRAIN_END)
    return season.fallback_lines(short, TEMPLATE)


def seasons_without_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season.incomplete_hotels(season_runs_query(spark, sf_dir))


def season_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season_table(
        _history(spark, sf_dir), _flags(spark, sf_dir), TRAIN_START, TRAIN_END,
        CALENDAR_START, CALENDAR_END, TEMPLATE, WEEKS, SEASONS,
    )


def segment_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir)


def predconf_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags written as text, read back by configured field names, made into rows."""
    path = scratch_path(spark, "flags")
    write_delimited(_flags(spark, sf_dir).select("htl_cd", "seg_cd", "is_pred"), path)
    return reference.predconf_rows(read_named_fields(spark, path, ["htl_cd", "seg_cd", "is_pred"]))


def price_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.price_model(star.hotel_bar_map(spark, sf_dir))


def inventory_field_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.inventory_field_defaults(
        star.inventory_fields(spark, sf_dir), star.hotels(spark, sf_dir)
    )


# --- backtest ----------------------------------------------------------------


def hotel_history_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtest.hotel_history_span(star.segment_daily(spark, sf_dir))


def backtest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtest.backtest_windows(hotel_history_span(spark, sf_dir), AS_OF, 0.8, 0.5, 365)


def hotel_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtest.hotel_units(star.hotels(spark, sf_dir), 7)


def backtest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtest.backtest_plan(
        star.segment_daily(spark, sf_dir), star.hotels(spark, sf_dir), AS_OF, 7, 0.8, 0.5, 365
    )


# --- SQL list ----------------------------------------------------------------

STATEMENTS = [
    SqlStatement("sql_left_inner_join", 1, """
        select k.c_custkey as customer, k.c_mktsegment as segment, upper(p.p_brand) as brand, o.o_totalprice / 2 as half_price
        from orders o
        join customer k on o.o_custkey = k.c_custkey
        left join part p on p.p_partkey = o.o_orderkey
        where k.c_acctbal >= 0 order by customer, half_price"""),
    SqlStatement("sql_group_avg", 2, """
        select p_type, max(p_size) as largest, count(*) as parts, round(avg(p_retailprice), 1) as mean_price
        from part group by p_type having count(*) > 1"""),
    SqlStatement("sql_date_fns", 3, """
        select o_orderkey, date_format(o_orderdate, 'yyyy/MM') as month,
               datediff(last_day(o_orderdate), o_orderdate) as days_left
        from orders"""),
]


def _statement_query(statement: SqlStatement) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_statements(spark, {t: star.table(spark, sf_dir, t) for t in ("customer", "part", "orders")}, [statement])[statement.name]

    return run


# --- around the forecast -----------------------------------------------------


def fit_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.fit_total(star.segment_daily(spark, sf_dir), _flags(spark, sf_dir)))


def pickup_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.pickup_matrix(star.segment_daily(spark, sf_dir)))


def _tagged(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    days = star.segment_daily(spark, sf_dir).select("htl_cd", "live_dt").distinct()
    return forecast.day_tags(
        days, star.quarter_seasons(spark, sf_dir), star.special_days(spark, sf_dir), mode
    )


def day_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, "weekday")


def day_tags_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, "weekendOrNot")


def day_tags_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, "noWeekday")


def day_tags_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, "sameTag")


def tag_history_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        forecast.tag_history_mean(
            star.segment_daily(spark, sf_dir), star.quarter_seasons(spark, sf_dir),
            star.special_days(spark, sf_dir), date(1996, 1, 1), date(2000, 12, 31),
        )
    )


def weighted_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        forecast.weighted_combine(
            star.long_forecast(spark, sf_dir), star.short_forecast(spark, sf_dir),
            star.weight_conf(spark, sf_dir),
        )
    )


def blend_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        forecast.blend_weights(
            star.actuals(spark, sf_dir), star.long_forecast(spark, sf_dir),
            star.short_forecast(spark, sf_dir), ["htl_cd", "seg_cd", "adv_days"],
        ),
        6,
    )


def _capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.hotel_capacity(star.inventory(spark, sf_dir), star.inventory_fields(spark, sf_dir))


def capacity_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        forecast.capacity_cap(star.actuals(spark, sf_dir), _capacity(spark, sf_dir))
    )


def proportional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        forecast.proportional_split(star.actuals(spark, sf_dir), star.fixed_totals(spark, sf_dir))
    )


def forecast_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = forecast.pickup_matrix(star.segment_daily(spark, sf_dir), dealt_by=["htl_cd", "seg_cd"])
    return rounded(forecast.forecast_sum(matrix, star.segment_prices(spark, sf_dir), _capacity(spark, sf_dir)))


def stored_forecast_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that three stored forecasts lack, each over its own span."""
    root = scratch_path(spark, "forecasts")
    stored = {"long": star.long_forecast, "short": star.short_forecast, "actual": star.actuals}
    for name, rows in stored.items():
        write_parquet(rows(spark, sf_dir), f"{root}/{name}")
    spans = {f"{root}/{name}": span for name, span in zip(stored, ((date(1998, 1, 1), 31), (date(1999, 3, 5), 365), (date(2001, 12, 1), 60)))}
    gaps = forecast.stored_forecast_gaps(spark.read.parquet(*spans), star.hotels(spark, sf_dir), spans)
    return gaps.withColumn("dir", F.element_at(F.split("dir", "/"), -1))


def forecast_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_gaps(
        star.actuals(spark, sf_dir), star.hotels(spark, sf_dir), date(1998, 1, 1), 365
    )


def all_queries() -> dict[str, Query]:
    plain = [
        scan_delimited, scan_hotel_dict, scan_parquet, reference_passthrough, roundtrip_delimited,
        overwritten_text, repartitioned_text, daily_job, file_to_file_curves,
        roundtrip_parquet, publish_by_hotel, publish_shared_first, reference_tables, scalar_dates,
        stay_nights, hotel_nights, area_orders, area_orders_from_nights, area_orders_fanout,
        event_sums, season_weekly_mean, season_bands, season_calendar, season_fallback,
        segment_flags, predconf_rows, price_model, inventory_field_defaults,
        hotel_history_span, backtest_windows, hotel_units, backtest_plan,
        fit_total, pickup_matrix, day_tags, day_tags_weekend, day_tags_season, day_tags_same, tag_history_mean,
        weighted_combine, blend_weights, capacity_cap, proportional_split,
        forecast_sum, forecast_gaps, stored_forecast_gaps,
    ]
    out: dict[str, Query] = {f.__name__: f for f in plain}
    out["read_snapshot"] = read_snapshot_query
    out["season_runs"] = season_runs_query
    out["season_table"] = season_table_query
    out["seasons_without_history"] = seasons_without_history
    out.update(_curve_queries())
    out.update({s.name: _statement_query(s) for s in STATEMENTS})
    return out
