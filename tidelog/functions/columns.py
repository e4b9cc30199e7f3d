"""Column expressions over envelopes and segment names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import TIMESTAMP_TYPES


def known_type(text: Column) -> Column:
    """A timestamp type's name; any other text means not_available."""
    return F.when(text.isin(*TIMESTAMP_TYPES.values()), text).otherwise(F.lit(TIMESTAMP_TYPES[-1]))


def payload_bytes(mode: str = "directory") -> Column:
    """Bytes of key and value, and of header keys and values unless mode is `object`; null counts 0."""
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")
    total = size(F.col("key")) + size(F.col("value"))
    if mode == "object":
        return total
    return total + F.aggregate(F.coalesce("headers", F.array()), F.lit(0).cast("bigint"), lambda n, h: n + size(h["key"]) + size(h["value"]))


def segment_name(first: Column, last: Column, ending: str = "parquet") -> Column:
    """<first>-<last>.<ending>, offsets to 20 digits."""
    return F.format_string(f"%020d-%020d.{ending}", first, last)


def parsed_name(name: Column) -> Column:
    """(first, last, ending) of a segment-shaped name, else null; a plus sign and any width are allowed."""
    shape = r"^(\+?[0-9]+)-(\+?[0-9]+)\.([^.]*)$"
    at = lambda i: F.regexp_extract(name, shape, i)
    number = lambda i: at(i).try_cast("decimal(38,0)")
    top = F.lit(str(2**64 - 1)).cast("decimal(38,0)")
    fits = name.rlike(shape) & (number(1) <= top) & (number(2) <= top)
    return F.when(fits & ~name.contains(".tmp."), F.struct(number(1).alias("first"), number(2).alias("last"), at(3).alias("ending")))
