"""Mask bits, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import IGNORE_BITS, MASK_BITS, MASK_SPECIAL, SAT_BIT


def _named(mask: Column) -> Column:
    bits = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(b).alias("bit")) for n, b in MASK_BITS))
    return F.transform(F.filter(bits, lambda b: mask.cast("int").bitwiseAND(b["bit"]) != 0), lambda b: b["name"])


def decode(mask, special: bool = True) -> Column:
    """Names of the set bits; the special values stand for one name alone unless special is off."""
    m = F.col(mask) if isinstance(mask, str) else mask
    out = _named(m)
    for name, value in reversed(MASK_SPECIAL if special else ()):
        out = F.when(m == value, F.array(F.lit(name))).otherwise(out)
    return out


def encode(flags) -> Column:
    """The bits of an array of names; the first special name decides alone, unknown names count nothing."""
    f = F.col(flags) if isinstance(flags, str) else flags
    values = F.create_map(*(F.lit(x) for pair in MASK_BITS for x in pair))
    special = F.create_map(*(F.lit(x) for pair in MASK_SPECIAL for x in pair))
    first = F.try_element_at(F.filter(f, lambda n: F.map_contains_key(special, n)), F.lit(1))
    plain = F.aggregate(f, F.lit(0), lambda acc, n: acc.bitwiseOR(F.coalesce(F.try_element_at(values, n), F.lit(0))))
    return F.when(first.isNotNull(), F.try_element_at(special, first)).otherwise(plain)


def ignore_mask(bits=IGNORE_BITS) -> int:
    out = 0
    for b in bits:
        out |= 1 << b
    return out


def ignored(mask, bits=IGNORE_BITS) -> Column:
    return F.col(mask).bitwiseAND(F.lit(ignore_mask(bits))) > 0


def clear_sat(mask, replaced=None) -> Column:
    """The mask without the saturation bit, set again where a pixel was replaced."""
    m = F.col(mask).bitwiseAND(F.lit(~(1 << SAT_BIT)))
    return m if replaced is None else F.when(replaced, m.bitwiseOR(F.lit(1 << SAT_BIT))).otherwise(m)
