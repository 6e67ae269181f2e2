"""Mean and deviation from integer moments.

Sliding-window statistics keep ``count``, ``sum`` and ``sum of squares`` of the
integer star values; these merge exactly (partial aggregation, minute
pre-aggregation, streaming state) and give the same double result in any SQL
engine, because the final division and square root are single IEEE operations.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_from_moments(n: Column, s: Column) -> Column:
    return F.try_divide(s.cast("double"), F.nullif(n, F.lit(0)).cast("double"))


def sample_std_from_moments(n: Column, s: Column, ss: Column) -> Column:
    """Sample standard deviation, NULL below two values (as ``stddev``)."""
    nd, sd, ssd = n.cast("double"), s.cast("double"), ss.cast("double")
    num = nd * ssd - sd * sd
    den = F.nullif(nd * (nd - F.lit(1.0)), F.lit(0.0))
    return F.sqrt(F.try_divide(num, den))


def pop_std_from_moments(n: Column, s: Column, ss: Column) -> Column:
    nd, sd, ssd = n.cast("double"), s.cast("double"), ss.cast("double")
    num = nd * ssd - sd * sd
    den = F.nullif(nd * nd, F.lit(0.0))
    return F.sqrt(F.try_divide(num, den))
