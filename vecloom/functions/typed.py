"""Typed metadata: VARIANT values made of JSON, and equality filters that compare values instead of text forms.

Equality is that of the values: 1, 1.0 and true are equal, "1" is equal to none of them, a missing key equals None, and
objects and arrays are equal if all their members are. Keys are whole names; a dot in one is part of it.
"""

import json
import math
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed(text: Column) -> Column:
    """The VARIANT value of JSON text; null where the text is null or no JSON."""
    return F.try_parse_json(text)


def as_json(value: Column) -> Column:
    return F.to_json(value)


def member(value: Column, key: str | int) -> Column:
    """The value of a key of an object, or of a place in an array, as a VARIANT; null if there is none."""
    if isinstance(key, int):
        return F.try_variant_get(value, f"$[{key}]", "variant")
    quote = next((q for q in "'\"" if q not in key), None)
    if quote is None:
        raise ValueError(f"no filter on a key with both kinds of quotes: {key}")
    return F.try_variant_get(value, f"$[{quote}{key}{quote}]", "variant")


def equals(value: Column, wanted: Any) -> Column:
    """Whether a VARIANT equals a Python value; never null."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    if wanted is None:
        return kind == "VOID"
    if isinstance(wanted, str):
        same = (kind == "STRING") & (F.try_variant_get(value, "$", "string") == wanted)
    elif isinstance(wanted, (bool, int, float)):
        if isinstance(wanted, float) and wanted.is_integer():
            wanted = int(wanted)
        number = F.try_variant_get(value, "$", "double") == float(wanted)
        if isinstance(wanted, float):
            same = kind.rlike("^(DECIMAL|DOUBLE|FLOAT|BIGINT)") & number if math.isfinite(wanted) else F.lit(False)
        else:
            whole = F.try_variant_get(value, "$", "bigint") == int(wanted) if -(2**63) <= wanted < 2**63 else F.lit(False)
            same = F.when(kind == "BIGINT", whole).when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), number)
            if wanted in (0, 1):
                same = same.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean") == bool(wanted))
    elif isinstance(wanted, dict):
        size = F.size(F.json_object_keys(F.to_json(value))) == len(wanted)
        same = _all([kind.startswith("OBJECT"), size, *(_present(member(value, k)) & equals(member(value, k), v) for k, v in wanted.items())])
    elif isinstance(wanted, (list, tuple)):
        size = F.json_array_length(F.to_json(value)) == len(wanted)
        same = _all([kind.startswith("ARRAY"), size, *(equals(member(value, i), v) for i, v in enumerate(wanted))])
    else:
        raise TypeError(f"no equality with {type(wanted).__name__}")
    return F.coalesce(same, F.lit(False))


def _present(value: Column) -> Column:
    return value.isNotNull()


def _all(parts: list[Column]) -> Column:
    return reduce(Column.__and__, parts)


def matches(value: Column, equal_to: dict[str, Any] | None) -> Column:
    """AND of equalities between members of a VARIANT object and Python values; ``metadata.`` before a key is left out."""
    passed = F.lit(True)
    for key, wanted in (equal_to or {}).items():
        passed = passed & equals(member(value, key.removeprefix("metadata.")), wanted)
    return passed


def text_form(value: Column) -> Column:
    """The text form that a metadata map holds of a VARIANT: strings as they are, null for null, JSON for the rest."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).when(kind != "VOID", F.to_json(value))


def literal(value: Any) -> Column:
    """A Python value as a VARIANT."""
    return F.parse_json(F.lit(json.dumps(value)))
