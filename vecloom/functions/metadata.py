"""Metadata maps and equality filters over them."""

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecloom import schemas


def render(value: Any) -> str | None:
    """Text form of a metadata value, the same for stored values and filter values."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return json.dumps(value, ensure_ascii=False)


def metadata_map(entries: dict[str, Column]) -> Column:
    pairs = [part for key, value in entries.items() for part in (F.lit(key), value.cast("string"))]
    return F.create_map(*pairs).cast(schemas.METADATA)


def merge(base: Column, override: Column) -> Column:
    """Union of two maps in which the right side wins; a null override changes nothing."""
    right = F.coalesce(override, F.create_map().cast(schemas.METADATA))
    kept = F.map_filter(base, lambda key, _: ~F.map_contains_key(right, key))
    return F.map_concat(kept, right)


def matches(equal_to: dict[str, Any] | None, columns: list[str], promoted: Sequence[str] = ()) -> Column:
    """AND of equalities. ``metadata.<key>`` looks into the map (the rest after the first dot is the key), or into the
    column of that name for keys that are ``promoted``, which lets the filter reach the scan. Any other key names a top-level
    column. A missing key equals None."""
    passed = F.lit(True)
    for key, value in (equal_to or {}).items():
        wanted = F.lit(render(value)).cast("string")
        if key.startswith("metadata."):
            inner = key.split(".", 1)[1]
            found = F.col(inner) if inner in promoted else F.col("metadata")[inner]
        elif key in columns:
            found = F.col(key).cast("string")
        else:
            found = F.lit(None).cast("string")
        passed = passed & found.eqNullSafe(wanted)
    return passed
