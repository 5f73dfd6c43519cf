"""Encoded partition paths: field segments followed by a time segment."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.options import LayoutOptions


def nested(df: DataFrame, path: str, root: str = "record") -> Column:
    """A dotted field of the record as text; steps through structs, maps and variants."""
    column, kind = F.col(root), df.schema[root].dataType
    rest = path
    while rest:
        name, _, rest = rest.partition(".")
        if isinstance(kind, T.StructType):
            if name not in kind.fieldNames():
                return F.lit(None).cast("string")
            column, kind = column[name], kind[name].dataType
        elif isinstance(kind, T.MapType):
            column, kind = F.try_element_at(column, F.lit(name)), kind.valueType
        elif isinstance(kind, T.VariantType):
            quoted = name.replace("'", "\\'")
            column = F.try_variant_get(column, f"$['{quoted}']", "variant")
        else:
            return F.lit(None).cast("string")
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(column, "$", "string")
    return column.cast("string")


def time_pattern(text: str) -> str:
    """The path format in Spark's letters: the week-year ``Y`` of stored configurations means the calendar year."""
    pieces = re.split(r"('[^']*')", text)
    return "".join(p if p.startswith("'") else p.replace("Y", "y") for p in pieces)


def time_segment(moment: Column, options: LayoutOptions) -> Column:
    """Record time in the layout's zone, floored to the partition duration and formatted."""
    local = moment if options.zone == "UTC" else F.from_utc_timestamp(moment, options.zone)
    millis = F.unix_millis(local)
    floored = F.timestamp_millis(millis - F.pmod(millis, F.lit(options.duration_ms)))
    return F.date_format(floored, time_pattern(options.path_format))


def safe_segment(value: Column) -> Column:
    """A field value as one folder name: it can neither leave its folder, nor hide, nor look like a folder of this package.

    ``%`` and ``/`` are percent-escaped, as are a leading ``.`` or ``_``; an empty value is a lone ``%``.
    """
    flat = F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))
    flat = F.regexp_replace(F.regexp_replace(flat, "^[.]", "%2E"), "^_", "%5F")
    return F.when(value == "", F.lit("%")).otherwise(flat)


def field_segment(values: dict[str, Column], options: LayoutOptions) -> Column:
    """Field values in order, each bare or as ``name=value`` under its full dotted name; NULL if any is NULL."""
    defaults = dict(options.defaults)
    pieces: list[Column] = []
    for name in options.fields:
        value = values[name]
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]))
        value = safe_segment(value)
        pieces.append(F.concat(F.lit(f"{name}="), value) if options.labelled else value)
        pieces.append(F.lit(options.delimiter))
    return F.concat(*pieces[:-1]) if pieces else F.lit(None).cast("string")
