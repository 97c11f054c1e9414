"""Table layouts. Column order is the contract of the delimited text files.

Ids are text unless the caller says otherwise: codes such as ``A12`` and
``007`` are read and written as they are. ``ids`` is the type of every id
column of a layout, for tables whose ids are known to be numbers.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _layout(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _D, _DATE = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()

TEXT = _S


def bookings_layout(ids: T.DataType = TEXT) -> T.StructType:
    return _layout(
        ("order_id", ids), ("hotel_id", ids), ("last_order_status", _S), ("order_dt", _DATE),
        ("arr_dt", _DATE), ("dpt_dt", _DATE), ("cancel_dt", _DATE), ("price_level", _I),
        ("room_id", _I), ("rns", _D), ("rev", _D),
    )


def hotel_dictionary_layout(ids: T.DataType = TEXT) -> T.StructType:
    """Fixed order of the tab-separated dictionary; names of columns that nothing uses are ours."""
    return _layout(
        ("hotel", ids), ("district", _S), ("location", ids), ("hotelname", _S), ("star", ids),
        ("city", ids), ("bookable", _S), ("zone", ids), ("street", _S), ("brand", _S),
        ("breakfast_local", _S), ("breakfast_west", _S), ("breakfast_china", _S),
        ("masterhotelid", ids), ("longitude", _S), ("latitude", _S), ("description", _S),
        ("hotelname_en", _S), ("status", _S), ("updatetime", _S),
    )


def hotel_nights_layout(ids: T.DataType = TEXT) -> T.StructType:
    return _layout(
        ("hotel_id_m", ids), ("order_status", _S), ("order_dt", _DATE), ("live_dt", _DATE),
        ("cancel_dt", _DATE), ("price_level", _I), ("sub_room_id", _I), ("rns", _D), ("rev", _D),
    )


def area_orders_layout(ids: T.DataType = TEXT) -> T.StructType:
    return _layout(
        ("city", ids), ("zone", ids), ("star", ids), ("location", ids), ("price_level", _I),
        ("order_dt", _DATE), ("live_dt", _DATE), ("cancel_dt", _DATE), ("rns", _D), ("rev", _D),
    )


BOOKINGS, HOTEL_DICTIONARY, HOTEL_NIGHTS, AREA_ORDERS = (
    layout() for layout in (bookings_layout, hotel_dictionary_layout, hotel_nights_layout, area_orders_layout)
)

SEGMENT_DAILY = _layout(
    ("htl_cd", _S), ("seg_cd", _S), ("is_member", _S), ("live_dt", _DATE),
    ("adv_days", _I), ("rns", _D), ("rev", _D),
)


def curve_layout(dims: list[str], ids: T.DataType = TEXT) -> T.StructType:
    """A curve file: two dimensions, a remark, stay date, advance day, measures."""
    return _layout(
        *[(d, ids) for d in dims], ("remark", _S), ("live_dt", _DATE),
        ("adv_days", _I), ("rns", _D), ("rev", _D),
    )


def text_layout(names: list[str]) -> T.StructType:
    """All-string layout for files described only by their field names."""
    return _layout(*[(n, _S) for n in names])
