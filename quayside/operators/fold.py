"""Extracting headers and folding them into the record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.headers import map_of, split_out
from quayside.functions.once import once
from quayside.options import FoldOptions
from quayside.sources.messages import first_error


def fold_headers(df: DataFrame, options: FoldOptions) -> DataFrame:
    """Put the wanted headers into ``record``, inline or by wrapping; rows without a value pass unchanged."""
    present, before = F.col("record").isNotNull(), df.columns
    df, values = split_out(df, options.names, "wanted")
    wanted = map_of(values)
    checks = []
    if options.mandatory and options.fail_on_missing:
        absent = {n: values[n].isNull() for n in options.mandatory}
        named = F.concat_ws(",", *[F.when(gone, F.lit(n)) for n, gone in absent.items()])
        some = reduce(lambda a, b: a | b, absent.values())
        checks.append(("headers", present & some, F.concat(F.lit("missing mandatory headers: "), named)))
    record, target = F.col("record"), options.target_field
    if options.wrap:
        folded = F.struct(wanted.alias(target), record.alias(options.payload_field))
    elif isinstance(df.schema["record"].dataType, T.MapType):
        folded = F.map_concat(
            F.map_filter(record, lambda k, _: k != target), F.create_map(F.lit(target), F.to_variant_object(wanted))
        )
    else:
        folded = record.withField(f"`{target}`", wanted)
    return df.select(
        *[c for c in before if c not in ("record", "error")], once(F.when(present, folded)).alias("record"),
        first_error(df, *checks).alias("error"),
    )
