"""Column selectors and scalar expressions."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name prefixes of the monetary families.
MONEY_PREFIXES = ("m", "Visa_m", "Master_m")

# Class labels.
STAYS = "CONTINUA"
LEAVES = "BAJA+"
LEAVES_IN_1 = "BAJA+1"
LEAVES_IN_2 = "BAJA+2"
LEAVES_IN_3 = "BAJA+3"


def family(df: DataFrame, prefixes: Iterable[str] = MONEY_PREFIXES, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose name starts with one of the prefixes, minus the excluded ones."""
    skip = set(exclude)
    return [c for c in df.columns if c.startswith(tuple(prefixes)) and c not in skip]


def matching(df: DataFrame, pattern: str, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose name matches a regular expression, minus the excluded ones."""
    skip = set(exclude)
    return [c for c in df.columns if re.search(pattern, c) and c not in skip]


def numeric(df: DataFrame, columns: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> list[str]:
    """The given (or all) columns that exist and hold numbers."""
    skip = set(exclude)
    wanted = df.columns if columns is None else [c for c in columns if c in df.columns]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in wanted if c not in skip and isinstance(kinds[c], T.NumericType)]


def ordered(df: DataFrame, first: Sequence[str], sort_rest: bool = False) -> DataFrame:
    """Put the named columns first; the others keep their order or go alphabetically."""
    head = [c for c in first if c in df.columns]
    rest = [c for c in df.columns if c not in set(head)]
    return df.select(*head, *(sorted(rest) if sort_rest else rest))


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Overwrite existing columns in place and append the others, in one projection."""
    kept = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    added = [e.alias(c) for c, e in new.items() if c not in df.columns]
    return df.select(*kept, *added)


def month_ordinal(period: str) -> Column:
    """Running month number of a yyyymm integer, so that 202012 and 202101 are neighbours."""
    return F.expr(f"`{period}` div 100 * 12 + `{period}` % 100").cast("int")


def ordinal(period: str, yyyymm: bool) -> Column:
    """Ordinal of a period column that holds either yyyymm or a plain running number."""
    return month_ordinal(period) if yyyymm else F.col(period).cast("int")


def calendar_month(period: str) -> Column:
    return F.col(period) % 100


def hash_bits(seed: object, *keys: str) -> Column:
    """32 reproducible bits of the key values and a seed, as a bigint."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed: object, *keys: str) -> Column:
    """Reproducible uniform number in [0, 1) that depends only on the row's keys."""
    return hash_bits(seed, *keys) / F.lit(4294967296.0)


def hash_normal(seed: object, *keys: str) -> Column:
    """Reproducible standard normal number (Box-Muller over two hash uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.log((hash_bits(f"{seed}a", *keys) + F.lit(1.0)) / F.lit(4294967296.0)))
    return radius * F.cos(F.lit(2 * math.pi) * hash_uniform(f"{seed}b", *keys))


def total(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def rounded(value: Column, digits: int) -> Column:
    """Round without leaving a negative zero."""
    return F.round(value, digits) + F.lit(0.0)
