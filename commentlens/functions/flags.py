"""Per-row flags of a filing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def onsite(proceedings: Column) -> Column:
    """Filed through the docket's own page: some proceeding entry has ``_index``; null if missing."""
    return F.exists(proceedings, lambda p: F.map_contains_key(p, "_index"))


def ingestion_method(browser: Column, proceedings: Column) -> Column:
    return (
        F.when(browser.startswith("OpenCSV"), F.lit("csv"))
        .when(onsite(proceedings), F.lit("direct"))
        .otherwise(F.lit("api"))
    )


def caps_email(email: Column) -> Column:
    """Address equals its upper-case form; null when missing or empty."""
    return F.when(email != "", email == F.upper(email))


def full_address(addresses: Column) -> Column:
    """First address has street, city, state and ZIP. Missing or empty lists give false."""
    first = F.get(addresses, F.lit(0))
    parts = [first[name] for name in ("address_line_1", "city", "state", "zip_code")]
    filled = F.lit(True)
    for part in parts:
        filled = filled & (F.coalesce(part, F.lit("")) != "")
    return filled


def proceeding_keys(proceedings: Column) -> Column:
    """Sorted keys of each entry, entries in array order; null if missing."""
    return F.array_join(
        F.flatten(F.transform(proceedings, lambda p: F.sort_array(F.map_keys(p)))), " "
    )


def shrink_proceedings(proceedings: Column) -> Column:
    """Keep only non-empty ``_index`` entries, and only that key of them."""
    kept = F.filter(proceedings, lambda p: F.coalesce(p["_index"], F.lit("")) != "")
    return F.transform(kept, lambda p: F.create_map(F.lit("_index"), p["_index"]))
