"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(text) -> Column:
    """Text as an exact number; NULL for anything else, NaN and infinities too."""
    return as_column(text).cast("string").try_cast("decimal(38,10)")


def _whole_text(text) -> Column:
    # Nearly every cell is a plain whole number; this settles it at the least cost.
    return as_column(text).cast("string").try_cast("bigint")


def whole(text) -> Column:
    """Text as a whole bigint; fractions and non-numbers give NULL."""
    n = number(text)
    return F.coalesce(_whole_text(text), F.when(n == F.floor(n), n.try_cast("bigint")))


def count_of(text) -> Column:
    """Text as a count: fractions are rounded, non-numbers give NULL."""
    return F.coalesce(_whole_text(text), F.round(number(text), 0).try_cast("bigint"))


def beyond_bigint(text) -> Column:
    """Whether text is a finite number that no bigint holds."""
    n = as_column(text).cast("string").try_cast("double")
    return F.coalesce((F.abs(n) >= F.lit(2.0 ** 63)) & (F.abs(n) < F.lit(float("inf"))), F.lit(False))


def count_or_zero(text) -> Column:
    """Report cell as a count: text that is no number and negatives become 0.

    A count too large for a bigint becomes NULL, which the row rules list; 0 would pass as data.
    """
    zero = F.lit(0).cast("bigint")
    plain = _whole_text(text)
    odd = F.when(beyond_bigint(text) & ~as_column(text).startswith("-"), F.lit(None).cast("bigint")
                 ).otherwise(F.greatest(F.coalesce(count_of(text), zero), zero))
    return F.when(plain.isNotNull(), F.greatest(plain, zero)).otherwise(odd)


def rounded(value, scale: int = 2) -> Column:
    """Round half up through an exact decimal, so 0.285 gives 0.29 everywhere."""
    return F.round(as_column(value).cast("decimal(38,10)"), scale).cast("double")


def percent(part, whole_) -> Column:
    """``part`` in percent of ``whole_``, two digits; NULL when the base is 0 or NULL."""
    base = F.nullif(as_column(whole_).cast("double"), F.lit(0.0))
    return rounded(as_column(part).cast("double") * 100.0 / base)
