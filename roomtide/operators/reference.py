"""Forecast reference tables and their publication per hotel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the default inventory field.
DEFAULT_INVENTORY_FIELD = "rooms"
#: Stands in the place of the hotel for tables that all hotels share.
SHARED = "shared"


def segment_flags(market_segments: DataFrame) -> DataFrame:
    """(htl_cd, seg_cd, is_pred) from the market segment table, by SQL."""
    return market_segments.sparkSession.sql(
        "select htl_cd, seg_cd, is_forecast as is_pred from {segments}",
        segments=market_segments,
    )


def flag_lines(flags: DataFrame, *keep: str) -> DataFrame:
    """``htl#seg#flag``, beside the columns to keep"""
    return flags.select(*keep, F.concat_ws("#", "htl_cd", "seg_cd", "is_pred").alias("line"))


def _joined(*parts: str) -> Column:
    """Concatenate separators and columns; NULL counts as the empty string."""
    return F.concat(*[
        F.coalesce(F.col(p).cast("string"), F.lit("")) if p.strip("#") else F.lit(p) for p in parts
    ])


def predconf_rows(flags: DataFrame, *keep: str) -> DataFrame:
    """Distinct ``#htl#seg###flag###`` rows, beside the columns to keep."""
    rows = flags.select("htl_cd", "seg_cd", "is_pred").distinct()
    return rows.select(*keep, _joined("#", "htl_cd", "#", "seg_cd", "###", "is_pred", "###").alias("line"))


def price_model(bar_map: DataFrame) -> DataFrame:
    """Distinct ``1#htl#season#room type#min#max#`` rows, by SQL projection."""
    rows = bar_map.sparkSession.sql(
        "select distinct htl_cd, season, zh_rt_cd, min_occ_pert, max_occ_pert from {hotel_bar_map}",
        hotel_bar_map=bar_map,
    )
    body = _joined(
        "#", "htl_cd", "#", "season", "#", "zh_rt_cd", "#", "min_occ_pert", "#", "max_occ_pert", "#"
    )
    return rows.select(F.concat(F.lit("1"), body).alias("line"))


def inventory_field_defaults(
    fields: DataFrame, hotels: DataFrame, default: str = DEFAULT_INVENTORY_FIELD
) -> DataFrame:
    """(htl_cd, field) rows plus a default row for each hotel, of either table, that has none or only nulls."""
    known = fields.where("field is not null").select("htl_cd", "field")
    named = hotels.select("htl_cd").unionByName(fields.where("field is null").select("htl_cd")).distinct()
    missing = named.join(known, "htl_cd", "left_anti")
    return known.unionByName(missing.withColumn("field", F.lit(default)))


def publish_by_hotel(content: DataFrame, hotels: DataFrame, version: str, name: str) -> DataFrame:
    """The lines of ``content`` (htl_cd, line) of every hotel in ``hotels``, each hotel its own.

    ``sources.publish_version`` stores the result.
    """
    own = content.join(hotels.select("htl_cd").distinct(), "htl_cd", "left_semi")
    return own.select(F.lit(version).alias("version"), "htl_cd", F.lit(name).alias("name"), "line")


def publish_shared(content: DataFrame, version: str, name: str) -> DataFrame:
    """A table that all hotels share, stored once per version under ``SHARED``."""
    return content.select(F.lit(version).alias("version"), F.lit(SHARED).alias("htl_cd"), F.lit(name).alias("name"), "line")
