"""All forecast reference tables of a version."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from roomtide.operators import reference
from roomtide.sources import BUCKETS, publish_version, write_partitioned


def reference_tables(
    version: str,
    hotels: DataFrame,
    flags: DataFrame,
    bar_map: DataFrame,
    season_lines: DataFrame,
    inventory_fields: DataFrame,
    others: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """(version, htl_cd, name, line) of every table.

    Forecast configuration, season lines and inventory fields, with a default
    line for hotels without one, are per hotel: each hotel of ``hotels`` has
    its own lines. Flags, price model and ``others`` (name to lines) are
    stored once per version, where every hotel finds them.
    """
    fields = reference.inventory_field_defaults(inventory_fields, hotels)
    own = {
        "predconf": reference.predconf_rows(flags, "htl_cd"),
        "season": season_lines,
        "invt_field_config": fields.select("htl_cd", F.concat_ws("#", "htl_cd", "field").alias("line")),
    }
    shared = {"is_predict": reference.flag_lines(flags), "price_model": reference.price_model(bar_map), **(others or {})}
    parts = [reference.publish_by_hotel(lines, hotels, version, name) for name, lines in own.items()]
    parts += [reference.publish_shared(lines, version, name) for name, lines in shared.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def publish_reference_tables(tables: DataFrame, root: str, version: str, buckets: int = BUCKETS) -> dict:
    """Publish the tables of one version, all at once (see ``sources.versions``); returns the manifest."""
    return publish_version(tables.where(F.col("version") == version), root, version, buckets)


def export_hotel_folders(tables: DataFrame, root: str) -> None:
    """Text files in ``<root>/version=…/name=…/htl_cd=…``, for readers that want a folder per hotel.

    This writes a folder and a file for every hotel and table: for few hotels.
    """
    write_partitioned(tables, root, ["version", "name", "htl_cd"], fmt="text")
