"""Oracle SQL for DuckDB, written from the row rules and not from the Spark plans."""

from __future__ import annotations

from catalogue.starschema import DIM_PAIRS

BOOKINGS = """
bookings as (
  select o.o_orderkey as order_id, l.l_suppkey as hotel_id, o.o_orderstatus as last_order_status,
         cast(o.o_orderdate as date) as order_dt,
         cast(o.o_orderdate as date) + cast((l.l_partkey*7+l.l_linenumber)%60-2 as integer) as arr_dt,
         cast(o.o_orderdate as date)
           + cast((l.l_partkey*7+l.l_linenumber)%60-2 + l.l_suppkey%5 as integer) as dpt_dt,
         case when l.l_returnflag='R'
              then cast(o.o_orderdate as date) + cast(l.l_partkey%40 as integer) end as cancel_dt,
         cast(l.l_partkey%8+1 as integer) as price_level,
         cast(l.l_partkey%10 as integer) as room_id,
         l.l_quantity as rns, l.l_extendedprice as rev
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey),
dictionary as (
  select s_suppkey as hotel, s_suppkey - s_suppkey%2 as masterhotelid, cast(s_nationkey as bigint) as city,
         cast(s_nationkey as bigint)*10 + s_suppkey%3 as zone, s_suppkey%5 as star, s_suppkey%7 as location
  from supplier),
nights as (
  select order_id, hotel_id, last_order_status, order_dt, cancel_dt, price_level, room_id,
         arr_dt + cast(k as integer) as live_dt,
         rns / (dpt_dt - arr_dt) as rns, rev / (dpt_dt - arr_dt) as rev
  from (select *, unnest(range(dpt_dt - arr_dt)) as k from bookings where dpt_dt > arr_dt))
"""

HOTEL_NIGHTS = BOOKINGS + """,
hotel_nights as (
  select coalesce(d.masterhotelid, n.hotel_id) as hotel_id_m, last_order_status as order_status, order_dt,
         live_dt, cancel_dt, price_level, room_id as sub_room_id, sum(rns) as rns, sum(rev) as rev
  from nights n left join dictionary d on n.hotel_id = d.hotel
  group by all)
"""


def _area(fanout: bool = False, since: str = "1900-01-01") -> str:
    own = "" if fanout else "and d.hotel = d.masterhotelid"
    return HOTEL_NIGHTS + f""",
area as (
  select city, zone, star, location, price_level, order_dt, live_dt, cancel_dt,
         sum(rns) as rns, sum(rev) as rev
  from hotel_nights h join dictionary d on h.hotel_id_m = d.masterhotelid {own}
  where live_dt >= date '{since}' and live_dt >= order_dt
  group by all)
"""


def _half_up(value: str, places: int = 4) -> str:
    """Rounding as the queries do it."""
    return f"floor(({value}) * 1e{places} + 0.5) / 1e{places}"


def _r(column: str) -> str:
    return f"{_half_up(column)} as {column}"


MEASURES = f"{_r('rns')}, {_r('rev')}"


def _raw(name: str, dims: str, event: str, where: str) -> str:
    return f""",
{name}_raw as (
  select {dims}, live_dt, live_dt - {event} as adv, sum(rns) as rns, sum(rev) as rev
  from area where {where} group by all),
{name}_span as (
  select {dims}, live_dt, greatest(min(adv), 0) as lo, greatest(max(adv), 0) as hi
  from {name}_raw group by all),
{name}_grid as (select {dims}, live_dt, unnest(range(lo, hi + 1)) as adv from {name}_span),
{name} as (
  select {', '.join('g.' + d.strip() for d in dims.split(','))}, g.live_dt, cast(g.adv as integer) as adv_days,
         coalesce(sum(r.rns), 0.0) as rns, coalesce(sum(r.rev), 0.0) as rev
  from {name}_grid g left join {name}_raw r
    on {' and '.join(f'g.{d.strip()} = r.{d.strip()}' for d in dims.split(','))}
   and g.live_dt = r.live_dt and g.adv = greatest(r.adv, 0)
  group by all)
"""


def _curves(dims: list[str]) -> str:
    names = ", ".join(dims)
    same = " and ".join(f"b.{c} = c.{c}" for c in [*dims, "live_dt", "adv_days"])
    picked = ", ".join(f"b.{c}" for c in [*dims, "live_dt", "adv_days"])
    return (
        _area()
        + _raw("booked", names, "order_dt", "true")
        + _raw("valid", names, "order_dt", "cancel_dt is null")
        + _raw("cancel", names, "cancel_dt", "cancel_dt is not null")
        + f""",
pickup as (
  select {picked}, b.rns - coalesce(c.rns, 0.0) as rns, b.rev - coalesce(c.rev, 0.0) as rev
  from booked b left join cancel c on {same})
"""
    )


def _text(*columns: str) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" for c in columns)


def _daily_job() -> str:
    """All curves of all pairs, by stay date; the running total of a stay date adds a day's sum once for itself and each smaller day."""
    steps, parts = [_area().replace("area as (", "area as materialized (")], []
    for pair, dims in DIM_PAIRS.items():
        names = ", ".join(dims)
        same = " and ".join(f"b.{c} = c.{c}" for c in [*dims, "live_dt", "adv_days"])
        steps += [
            _raw(f"booked_{pair}", names, "order_dt", "true"), _raw(f"valid_{pair}", names, "order_dt", "cancel_dt is null"),
            _raw(f"cancel_{pair}", names, "cancel_dt", "cancel_dt is not null"),
            f""",
pickup_{pair} as (
  select b.* replace (b.rns - coalesce(c.rns, 0.0) as rns, b.rev - coalesce(c.rev, 0.0) as rev) from booked_{pair} b left join cancel_{pair} c on {same})
""",
        ]
        for name in (f"cancel_{pair}", f"valid_{pair}", f"pickup_{pair}"):
            for acc, times in (("", "1"), ("_acc", "(adv_days - lo + 1)")):
                parts.append(f"""
select '{name}{acc}' as curve, cast({dims[0]} as varchar) as dim1, cast({dims[1]} as varchar) as dim2, live_dt,
       count(*) as days, max(adv_days) as last_day, {_half_up(f'sum(rns * {times})')} as rns, {_half_up(f'sum(rev * {times})')} as rev
from (select *, min(adv_days) over (partition by {names}, live_dt) as lo from {name}) group by all""")
    return "with " + "".join(steps) + " union all ".join(parts)


def _curve_oracles() -> dict[str, str]:
    out = {}
    for pair, dims in DIM_PAIRS.items():
        names = ", ".join(dims)
        head = "with " + _curves(dims)
        plain = f" select {names}, live_dt, adv_days, {MEASURES} from "
        running = f""", running as (
          select {names}, live_dt, adv_days,
                 sum(rns) over w as rns, sum(rev) over w as rev
          from %s window w as (partition by {names}, live_dt order by adv_days desc
                               rows between unbounded preceding and current row))"""
        out[f"advance_totals_{pair}"] = (
            head + f" select {names}, live_dt, cast(adv as integer) as adv_days, {MEASURES} from booked_raw"
        )
        out[f"densify_{pair}"] = head + plain + "booked"
        out[f"pickup_joined_{pair}"] = head + plain + "pickup"
        for name in ("cancel", "valid", "pickup"):
            out[f"{name}_{pair}"] = head + plain + name
            out[f"{name}_{pair}_acc"] = head + running % name + plain + "running"
    out["cumulative_city_star"] = out["valid_city_star_acc"]
    out["roundtrip_delimited"] = (
        "with " + _curves(DIM_PAIRS["city_star"])
        + f" select {_text('city', 'star')}, cast(null as varchar) as remark, live_dt, adv_days, {MEASURES} from valid"
    )
    out["file_to_file_curves"] = (
        "with " + _curves(DIM_PAIRS["zone_star"]) + f"""
        select {_text('zone', 'star')}, live_dt, adv_days, {_half_up('sum(rns) over w')} as rns, {_half_up('sum(rev) over w')} as rev
        from pickup window w as (partition by zone, star, live_dt order by adv_days desc rows between unbounded preceding and current row)"""
    )
    out["daily_job"] = _daily_job()
    return out


def _event_sums() -> str:
    """Per pair, booked, valid and cancelled sums put side by side."""
    parts = []
    for pair, dims in DIM_PAIRS.items():
        columns = ", ".join(d if d in dims else f"cast(null as bigint) as {d}" for d in ("city", "star", "zone"))
        parts.append(f"""
          select '{pair}' as pair, {columns}, live_dt, cast(greatest(adv, 0) as integer) as adv_days,
                 bool_or(kind = 'b') as booked, bool_or(kind = 'b' and cancel_dt is null) as valid,
                 bool_or(kind = 'c') as gone,
                 coalesce(sum(rns) filter (where kind = 'b'), 0.0) as booked_rns,
                 coalesce(sum(rev) filter (where kind = 'b'), 0.0) as booked_rev,
                 coalesce(sum(rns) filter (where kind = 'b' and cancel_dt is null), 0.0) as valid_rns,
                 coalesce(sum(rev) filter (where kind = 'b' and cancel_dt is null), 0.0) as valid_rev,
                 coalesce(sum(rns) filter (where kind = 'c'), 0.0) as gone_rns,
                 coalesce(sum(rev) filter (where kind = 'c'), 0.0) as gone_rev
          from happened group by {', '.join(dims)}, live_dt, greatest(adv, 0)""")
    measures = ", ".join(_r(f"{k}_{m}") for k in ("booked", "valid", "gone") for m in ("rns", "rev"))
    return f"""with {_area()}, happened as (
          select *, 'b' as kind, live_dt - order_dt as adv from area
          union all select *, 'c', live_dt - cancel_dt from area where cancel_dt is not null),
        everything as ({' union all '.join(parts)})
        select pair, city, star, zone, live_dt, adv_days, booked, valid, gone, {measures} from everything"""


# --- segment tables ----------------------------------------------------------

_KEYS = """cast(l_suppkey as varchar) as htl_cd, l_returnflag || l_linestatus as seg_cd"""
_ADV = "cast(((l_partkey*7+l_linenumber)%20) * ((l_partkey*7+l_linenumber)%21) as integer) as adv_days"

SEGMENTS = f"""
segments as (
  select {_KEYS}, case when l_linenumber%2=0 then 'Y' else 'N' end as is_member,
         cast(l_shipdate as date) as live_dt, {_ADV},
         sum(l_quantity) as rns, sum(l_extendedprice) as rev
  from lineitem group by all),
flags as (
  select distinct {_KEYS},
         case when (l_suppkey + ascii(l_returnflag))%4 = 0 then 'N' else 'Y' end as is_pred
  from lineitem)
"""

SEASON = SEGMENTS + """,
first_day as (
  select htl_cd, min(live_dt) as first_dt, greatest(min(live_dt), date '1995-01-01') as train_from
  from segments group by 1),
long_history as (select * from first_day where date '1996-01-12' - train_from >= 365),
daily as (
  select s.htl_cd, s.live_dt, sum(s.rns) as rns
  from segments s join long_history h on s.htl_cd = h.htl_cd
  where s.live_dt between h.train_from and date '1996-01-12'
    and not exists (select 1 from flags f
                    where f.htl_cd = s.htl_cd and f.seg_cd = s.seg_cd and f.is_pred = 'N')
  group by all),
weekly as (
  select htl_cd, cast(weekofyear(live_dt) // 2 as integer) as bucket, avg(rns) as mean_rns
  from daily group by all),
edges as (select htl_cd, min(mean_rns) as lo, max(mean_rns) as hi from weekly group by 1),
banded as (
  select w.htl_cd, w.bucket, cast(coalesce(
           (select min(i) from range(1, 6) t(i) where (e.hi - e.lo) * i / 5 + e.lo + 0.0001 >= w.mean_rns),
           0) as integer) as season_id
  from weekly w join edges e on w.htl_cd = e.htl_cd),
dates as (
  select cast(d as date) as live_dt
  from generate_series(timestamp '1996-01-01', timestamp '1997-12-31', interval 1 day) t(d)),
calendar as (
  select h.htl_cd, d.live_dt, b.season_id
  from (select distinct htl_cd from weekly) h cross join dates d
  left join banded b on b.htl_cd = h.htl_cd and b.bucket = weekofyear(d.live_dt) // 2),
numbered as (
  select *, row_number() over (partition by htl_cd order by live_dt)
            - row_number() over (partition by htl_cd, season_id order by live_dt) as island
  from calendar),
runs as (
  select htl_cd, season_id, min(live_dt) as start_dt, max(live_dt) as end_dt
  from numbered group by htl_cd, season_id, island),
short_history as (select htl_cd from first_day where date '1996-01-12' - train_from < 365),
fallback as (
  select htl_cd, htl_cd || unnest(['#1####1996-01-01#1996-06-30', '#2####1996-07-01#1997-12-31']) as line
  from short_history)
"""

FORECASTS = f"""
actual as (
  select {_KEYS}, cast(l_shipdate as date) as live_dt, {_ADV}, sum(l_quantity) as rns
  from lineitem group by all),
long_term as (
  select {_KEYS}, cast(l_shipdate as date) as live_dt, {_ADV}, sum(l_quantity + l_linenumber) as rns
  from lineitem group by all),
short_term as (
  select {_KEYS}, cast(l_shipdate as date) as live_dt, {_ADV}, sum(l_quantity * (l_partkey%3+1)) as rns
  from lineitem group by all)
"""

TAGS = SEGMENTS + """,
special as (
  select distinct cast(o_orderdate as date) as day, month(o_orderdate) as code
  from orders where day(o_orderdate) = 1),
days as (select distinct htl_cd, live_dt from segments),
tagged as (
  select htl_cd, live_dt, code,
         (cast(htl_cd as bigint) + (year(live_dt) - 1995) * 4 + quarter(live_dt) - 1) % 4 as season,
         isodow(live_dt) as dow
  from days left join special on live_dt = day)
"""

# What a hotel's field names: rooms by default.
CAPS = """select cast(s_suppkey as varchar) as htl_cd,
    cast(case when s_suppkey%3 <> 0 and s_suppkey%2 = 1 then s_suppkey%25+10 when s_suppkey%7 <> 0 then s_suppkey%30+20 end as double) as cap from supplier"""

# The columns of an advance-day matrix.
_COLUMNS = [*range(16), 22, 29, 36, 43, 57, 71, 85, 119, 147, 175, 203, 231, 259, 287, 315, 343, 365]


def _matrix() -> str:
    cells = []
    low = -1000000
    for high in _COLUMNS:
        cells.append(
            f"coalesce(sum(rns) filter (where adv_days > {low} and adv_days <= {high}), 0.0) as d_{high}"
        )
        low = high
    cells.append(f"coalesce(sum(rns) filter (where adv_days > {low}), 0.0) as d_over")
    return f"select htl_cd, seg_cd, live_dt, {', '.join(cells)} from segments group by all"


WINDOWS = """
spans as (
  select cast(l_suppkey as varchar) as htl_cd, cast(min(l_shipdate) as date) as lo,
         least(cast(max(l_shipdate) as date), date '2001-06-30') as hi
  from lineitem group by 1),
ends as (select *, lo + cast(trunc((hi - lo) * 0.8) as integer) as train_end from spans),
windows as (
  select htl_cd, train_end - 365 as weight_start, train_end as weight_end, lo as train_start, train_end,
         hi - cast(trunc((hi - lo) * 0.5) as integer) as test_start, hi as test_end
  from ends)
"""

UNITS = """
listed as (
  select cast(s_suppkey as varchar) as htl_cd,
         row_number() over (order by cast(s_suppkey as varchar)) - 1 as i,
         count(*) over () as total, least(7, count(*) over ()) as p
  from supplier),
units as (
  select htl_cd, cast(case when i < p * (total // p) then i // (total // p)
                           else i - p * (total // p) end as bigint) as unit_no
  from listed)
"""

def all_oracles() -> dict[str, str]:
    area_columns = "city, zone, star, location, price_level, order_dt, live_dt, cancel_dt"
    night_columns = "hotel_id_m, order_status, order_dt, live_dt, cancel_dt, price_level, sub_room_id"
    area = f"with {_area()} select {area_columns}, {MEASURES} from area"
    recent = f"with {_area(since='1996-01-01')} select {area_columns}, {MEASURES} from area"
    per_hotel = f"with {HOTEL_NIGHTS} select {night_columns}, {MEASURES} from hotel_nights"
    predconf = f"""select '#' || htl_cd || '#' || seg_cd || '###' || is_pred || '###' as line from flags"""
    keys = "htl_cd, seg_cd, live_dt, adv_days"
    tag = "coalesce('H' || code, 'S' || season || {part}) as tag"
    out = {
        "scan_delimited": f"with {_area()} select {_text('city', 'zone', 'star', 'location')}, price_level, order_dt, live_dt, cancel_dt, {MEASURES} from area",
        "overwritten_text": "select cast(c_custkey as varchar) as custkey, c_mktsegment as segment from customer",
        "repartitioned_text": "select cast(o_orderkey as varchar) as orderkey, o_orderpriority as priority, 3 as files from orders",
        "scan_hotel_dict": """
            select s_suppkey || '' as hotel, s_name as hotelname, s_suppkey%5 || '' as star,
                   s_nationkey || '' as city, cast(s_nationkey as bigint)*10 + s_suppkey%3 || '' as zone,
                   s_suppkey%7 || '' as location, s_suppkey - s_suppkey%2 || '' as masterhotelid,
                   '2016-01-01 00:00:00' as updatetime
            from supplier""",
        "scan_parquet": """
            select l_returnflag, count(*) as n, sum(l_quantity) as quantity from lineitem group by 1""",
        "read_snapshot": """
            select o_orderkey, o_custkey, o_totalprice from orders
            where year(o_orderdate) = 2001 and month(o_orderdate) = 6""",
        "reference_passthrough": "select c_custkey || '#' || c_name as line from customer",
        "roundtrip_parquet": per_hotel,
        "publish_by_hotel": f"""
            with {SEGMENTS} select 'v1' as version, htl_cd, 'is_predict' as name,
                   htl_cd || '#' || seg_cd || '#' || is_pred as line from flags""",
        "publish_shared_first": f"""
            with {SEGMENTS}
            select 'v1' as version, htl_cd, 'predconf' as name, '#' || htl_cd || '#' || seg_cd || '###' || is_pred || '###' as line from flags
            union all
            select 'v1', 'shared', 'is_predict', htl_cd || '#' || seg_cd || '#' || is_pred from flags""",
        "reference_tables": f"""
            with {SEGMENTS}
            select 'v1' as version, htl_cd, 'predconf' as name, '#' || htl_cd || '#' || seg_cd || '###' || is_pred || '###' as line from flags
            union all select 'v1', 'shared', 'is_predict', htl_cd || '#' || seg_cd || '#' || is_pred from flags
            union all select 'v1', cast(s_suppkey as varchar), 'season', s_suppkey || '#1' from supplier
            union all select 'v1', cast(s_suppkey as varchar), 'invt_field_config',
                   s_suppkey || case when s_suppkey%3 = 0 or s_suppkey%2 = 0 then '#rooms' else '#tosell' end from supplier
            union all select distinct 'v1', 'shared', 'price_model', '1#' || l_suppkey || '#' || (l_partkey%4+1) || '#RT' || (l_linenumber%3)
                   || '#' || (l_partkey%5*20) || '#' || (l_partkey%5*20+20) || '#' from lineitem""",
        "scalar_dates": """
            select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as dashed,
                   cast(strftime(o_orderdate, '%Y%m%d') as integer) as compact, cast(day(o_orderdate) as integer) as apart
            from orders""",
        "stay_nights": f"""
            with {BOOKINGS} select order_id, hotel_id, last_order_status, order_dt, cancel_dt, price_level,
                   room_id, live_dt, {MEASURES} from nights""",
        "hotel_nights": per_hotel,
        "area_orders": recent,
        "area_orders_from_nights": recent,
        "area_orders_fanout": f"with {_area(fanout=True, since='1996-01-01')} select {area_columns}, {MEASURES} from area",
        "event_sums": _event_sums(),
        "season_weekly_mean": f"with {SEASON} select htl_cd, bucket, {_r('mean_rns')} from weekly",
        "season_bands": f"with {SEASON} select htl_cd, bucket, season_id from banded",
        "season_calendar": f"with {SEASON} select htl_cd, live_dt, season_id from calendar",
        "season_runs": f"with {SEASON} select htl_cd, season_id, start_dt, end_dt from runs",
        "season_fallback": f"with {SEASON} select htl_cd, line from fallback",
        "season_table": f"""
            with {SEASON}, gaps as (select distinct htl_cd from calendar where season_id is null)
            select htl_cd, htl_cd || '#' || season_id || '####' || start_dt || '#' || end_dt as line
            from runs where htl_cd not in (select htl_cd from gaps)
            union all select htl_cd, htl_cd || unnest(['#1####1996-01-01#1996-06-30', '#2####1996-07-01#1997-12-31']) from gaps
            union all select htl_cd, line from fallback""",
        "seasons_without_history": f"with {SEASON} select distinct htl_cd from calendar where season_id is null",
        "segment_flags": f"with {SEGMENTS} select htl_cd, seg_cd, is_pred from flags",
        "predconf_rows": f"with {SEGMENTS} {predconf}",
        "price_model": """
            select distinct '1#' || l_suppkey || '#' || (l_partkey%4+1) || '#RT' || (l_linenumber%3) || '#'
                   || (l_partkey%5*20) || '#' || (l_partkey%5*20+20) || '#' as line from lineitem""",
        "inventory_field_defaults": """
            select cast(s_suppkey as varchar) as htl_cd,
                   case when s_suppkey%3 = 0 or s_suppkey%2 = 0 then 'rooms' else 'tosell' end as field
            from supplier""",
        "hotel_history_span": """
            select cast(l_suppkey as varchar) as htl_cd, cast(min(l_shipdate) as date) as min_dt,
                   cast(max(l_shipdate) as date) as max_dt
            from lineitem group by 1""",
        "backtest_windows": f"with {WINDOWS} select * from windows",
        "hotel_units": f"with {UNITS} select htl_cd, unit_no from units",
        "backtest_plan": f"with {UNITS}, {WINDOWS} select * from units left join windows using (htl_cd)",
        "fit_total": f"""
            with {SEGMENTS} select htl_cd, live_dt, adv_days, {_half_up('sum(rns)')} as rns,
                   {_half_up('sum(rev)')} as rev, 'FIT_TOTAL' as seg_cd
            from segments join flags using (htl_cd, seg_cd) where is_pred = 'Y'
            group by htl_cd, live_dt, adv_days""",
        "pickup_matrix": f"with {SEGMENTS} {_matrix()}",
        "day_tags": f"with {TAGS} select htl_cd, live_dt, " + tag.format(part="'-W' || dow") + " from tagged",
        "day_tags_weekend": f"with {TAGS} select htl_cd, live_dt, "
        + tag.format(part="case when dow in (5,6,7) then '-E' else '-D' end") + " from tagged",
        "day_tags_season": f"with {TAGS} select htl_cd, live_dt, " + tag.format(part="''") + " from tagged",
        "day_tags_same": "select distinct cast(l_suppkey as varchar) as htl_cd, cast(l_shipdate as date) as live_dt, 'S' as tag from lineitem",
        "tag_history_mean": f"""
            with {TAGS}, tags as (select htl_cd, live_dt, {tag.format(part="'-W' || dow")} from tagged),
            per_day as (
              select htl_cd, seg_cd, live_dt, adv_days, sum(rns) as rns from segments
              where live_dt between date '1996-01-01' and date '2000-12-31' group by all)
            select htl_cd, seg_cd, tag, adv_days, {_half_up('avg(rns)')} as mean_rns
            from per_day join tags using (htl_cd, live_dt) group by all""",
        "weighted_combine": f"""
            with {FORECASTS}, conf as (
              select distinct {_KEYS}, {_ADV} from lineitem where l_suppkey%2 = 0)
            select {keys}, floor((
                case when c.htl_cd is null then 1.0::double else cast('0.' || (adv_days%10) as double) end
                  * coalesce(l.rns, 0.0)
              + case when c.htl_cd is null then 0.0::double else cast('0.' || ((adv_days+3)%10) as double) end
                  * coalesce(s.rns, 0.0)) * 1e4 + 0.5) / 1e4 as rns
            from long_term l full join short_term s using ({keys})
            left join conf c using (htl_cd, seg_cd, adv_days)""",
        "blend_weights": f"""
            with {FORECASTS}, sums as (
              select htl_cd, seg_cd, adv_days, sum(l.rns*l.rns) as aa, sum(s.rns*s.rns) as bb,
                     sum(l.rns*s.rns) as ab, sum(l.rns*y.rns) as ay, sum(s.rns*y.rns) as sy
              from actual y join long_term l using ({keys}) join short_term s using ({keys})
              group by 1, 2, 3),
            fitted as (select *, aa*bb - ab*ab as det from sums)
            select htl_cd, seg_cd, adv_days,
                   {_half_up("case when det > 1e-9*aa*bb then (ay*bb - sy*ab)/det else 1.0 end", 6)} as w1,
                   {_half_up("case when det > 1e-9*aa*bb then (sy*aa - ay*ab)/det else 0.0 end", 6)} as w2
            from fitted""",
        "capacity_cap": f"""
            with {FORECASTS}, totals as (
              select htl_cd, live_dt, adv_days, sum(rns) as total from actual group by all),
            caps as (
              {CAPS})
            select {keys}, {_half_up("case when total > cap then rns * (cap / total) else rns end")} as rns
            from actual join totals using (htl_cd, live_dt, adv_days) left join caps using (htl_cd)""",
        "proportional_split": f"""
            with {FORECASTS}, totals as (
              select htl_cd, live_dt, adv_days, sum(rns) as total, count(*) as n from actual group by all),
            fixed as (
              select cast(l_suppkey as varchar) as htl_cd, cast(l_shipdate as date) as live_dt, {_ADV},
                     cast(sum(l_linenumber) as double) as fixed
              from lineitem where l_partkey%3 <> 0 group by all)
            select {keys}, {_half_up("case when fixed is null then rns when total <> 0 then fixed * (rns / total) else fixed / n end")}
                   as rns
            from actual join totals using (htl_cd, live_dt, adv_days)
            left join fixed using (htl_cd, live_dt, adv_days)""",
        "forecast_sum": f"""
            with {SEGMENTS}, prices as (
              select {_KEYS}, round(sum(l_extendedprice) / sum(l_quantity), 2) as price
              from lineitem group by all)
            select htl_cd, live_dt, {_half_up('sum(rns)')} as rns,
                   {_half_up('sum(rns * price)')} as rev, {_half_up('sum(rns) / any_value(cap)')} as occupancy
            from segments join prices using (htl_cd, seg_cd) left join ({CAPS}) using (htl_cd) group by htl_cd, live_dt""",
        "stored_forecast_gaps": """
            with spans(dir, start, n) as (values ('long', date '1998-01-01', 31), ('short', date '1999-03-05', 365), ('actual', date '2001-12-01', 60)),
            expected as (
              select dir, cast(s_suppkey as varchar) as htl_cd, start + cast(k as integer) as live_dt
              from supplier, spans, range(365) t(k) where k < n)
            select e.* from expected e anti join lineitem on htl_cd = cast(l_suppkey as varchar) and live_dt = cast(l_shipdate as date)""",
        "forecast_gaps": """
            with expected as (
              select cast(s_suppkey as varchar) as htl_cd, date '1998-01-01' + cast(k as integer) as live_dt
              from supplier, range(365) t(k))
            select htl_cd, live_dt from expected
            except select cast(l_suppkey as varchar), cast(l_shipdate as date) from lineitem""",
    }
    out["sql_left_inner_join"] = """
        with priced as (select o_custkey, o_orderkey, o_totalprice / 2 as half_price from orders)
        select c_custkey as customer, c_mktsegment as segment,
               (select upper(p_brand) from part where p_partkey = o_orderkey) as brand, half_price
        from customer, priced where c_custkey = o_custkey and not c_acctbal < 0"""
    out["sql_group_avg"] = """
        select distinct p_type, max(p_size) over w as largest, count(*) over w as parts, round(avg(p_retailprice) over w, 1) as mean_price
        from part window w as (partition by p_type) qualify count(*) over w >= 2"""
    out["sql_date_fns"] = """
        select o_orderkey, year(o_orderdate) || '/' || lpad(cast(month(o_orderdate) as varchar), 2, '0') as month,
               cast(day(date_trunc('month', o_orderdate) + interval 1 month - interval 1 day) - day(o_orderdate) as integer) as days_left
        from orders"""
    out.update(_curve_oracles())
    return out
