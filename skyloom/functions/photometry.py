"""Fluxes, magnitudes and header numbers, as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import HEADER_DEFAULTS, ZERO_POINT

A = 2.5 / math.log(10)


def flux(data, boffset, bsoften, exptime) -> Column:
    return (boffset + 2 * bsoften * F.sinh(data / A)) / exptime


def flux_error(data, boffset, bsoften, exptime) -> Column:
    """The square root comes before the division; NaN below zero."""
    return F.sqrt(boffset + 2 * bsoften * F.sinh(data / A)) / exptime


def header_numbers(header) -> Column:
    """boffset, bsoften, exptime of a header map; all defaults if any is missing or not a number."""
    h = F.col(header) if isinstance(header, str) else header
    own = {k: F.try_element_at(h, F.lit(k.upper())).try_cast("double") for k in HEADER_DEFAULTS}
    good = own["boffset"].isNotNull() & own["bsoften"].isNotNull() & own["exptime"].isNotNull()
    return F.struct(*(F.when(good, c).otherwise(F.lit(HEADER_DEFAULTS[k])).alias(k) for k, c in own.items()))


def mag_to_flux(mag, zero: float = ZERO_POINT) -> Column:
    return F.pow(F.lit(10.0), (F.lit(zero) - mag) / 2.5)


def flux_to_mag(value, zero: float = ZERO_POINT) -> Column:
    return F.lit(zero) - 2.5 * F.log10(value)


def replacement_threshold(peak, mag: float = 15.0) -> Column:
    return F.pow(F.lit(10.0), F.lit((mag - ZERO_POINT) / -2.5)) * peak
