"""Tax ID formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions.cleansing import _col


def format_tin(tin: Column | str, mode: str = "reference") -> Column:
    """Tax ID text ``dd-ddddddd``.

    ``reference`` keeps the published output for short IDs, in which the
    leading zeros shrink to a single one: up to 6 digits give ``0-0`` + tin, 7
    give ``0-`` + tin. ``padded`` fills every ID of up to 9 digits with zeros.
    Longer IDs stay as they are in both modes.
    """
    text = _col(tin).cast("string")
    size = F.length(text)
    if mode == "padded":
        nine = F.lpad(text, 9, "0")
        dashed = F.concat(F.substring(nine, 1, 2), F.lit("-"), F.substring(nine, 3, 7))
        return F.when(size.between(1, 9), dashed).otherwise(text)
    if mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        F.when(size.between(1, 6), F.concat(F.lit("0-0"), text))
        .when(size == 7, F.concat(F.lit("0-"), text))
        .when(size == 8, F.concat(F.lit("0"), F.substring(text, 1, 1), F.lit("-"), F.substring(text, 2, 7)))
        .when(size == 9, F.concat(F.substring(text, 1, 2), F.lit("-"), F.substring(text, 3, 7)))
        .otherwise(text)
    )
