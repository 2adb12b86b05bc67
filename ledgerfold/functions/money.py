"""Amounts, currencies, conversion and billing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import CURRENCY_MARKERS, MONEY, NETTING_NO, NETTING_YES, RATE, RAW, USUAL_MONEY, USUAL_RATE
from .text import is_blank, norm_key, strip

__all__ = ["parse_amount", "lenient_number", "amount_fault", "number_fault", "rate_fault", "detect_currency",
           "row_currency", "round2", "to_eur", "times_rate", "decimal_comma", "currency_default",
           "netting_default", "billing_total"]


def parse_amount(c: Column) -> Column:
    """Amount in a money text such as '€1,234.56'. Symbols, letters and thousands
    separators are dropped; what is then no number counts as 0."""
    digits = F.regexp_replace(c, r"[^0-9.\-]", "")
    return F.coalesce(digits.try_cast(RAW), F.lit(0).cast(RAW))


def lenient_number(c: Column) -> Column:
    """Plain numeric text; anything else (also '1,234.56') counts as 0."""
    return F.coalesce(strip(c).try_cast(RAW), F.lit(0).cast(RAW))


def _too_large(number: Column, kind) -> Column:
    """'too large' for a plain or exponent number that the type cannot hold."""
    return F.when(number.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$") & number.try_cast(kind).isNull(), "too large")


def amount_fault(c: Column) -> Column:
    """Why `parse_amount` cannot hold the amount in a money text; null where it can, and for a text without a number.
    A text of up to 28 characters always fits."""
    return F.when(F.length(c) > RAW.precision - RAW.scale, _too_large(F.regexp_replace(c, r"[^0-9.\-]", ""), RAW))


def number_fault(c: Column) -> Column:
    """The same for `lenient_number`."""
    return _too_large(strip(c), RAW)


def rate_fault(c: Column) -> Column:
    """Why a rate cannot be used: it does not fit, or only its digits behind the eighth decimal are not zero."""
    text = strip(c)
    small = (text.try_cast(RATE) == 0) & F.rlike(F.regexp_replace(text, "[eE].*$", ""), F.lit("[1-9]"))
    return F.coalesce(_too_large(text, RATE), F.when(small, "too small"))


def detect_currency(c: Column) -> Column:
    """ISO code of the first marker, in marker order, found anywhere in the text."""
    found = F.lit(None).cast("string")
    for marker, code in reversed(CURRENCY_MARKERS):
        found = F.when(F.contains(c, F.lit(marker)), F.lit(code)).otherwise(found)
    return found


def row_currency(cells: Iterable[Column]) -> Column:
    """First currency detected in the given cells, in order."""
    return F.coalesce(*[detect_currency(c) for c in cells])


def round2(c: Column) -> Column:
    """Half-up to cents."""
    return F.round(c, 2).cast(MONEY)


def to_eur(value: Column, rate: Column) -> Column:
    """value / rate in cents; null without a rate or with a zero rate. Only amounts and rates of unusual
    length take the division that keeps six decimals."""
    usual = F.try_divide(value.try_cast(USUAL_MONEY), rate.try_cast(USUAL_RATE))
    return F.coalesce(round2(usual), F.round(F.try_divide(value, rate), 2).try_cast(MONEY))


def times_rate(value: Column, rate: Column) -> Column:
    """value x rate, not rounded to cents; null where either is null or the product has more than 28 digits."""
    usual = value.try_cast(USUAL_MONEY) * rate.try_cast(USUAL_RATE)
    return F.coalesce(usual.cast(RAW), F.try_multiply(value, rate).try_cast(RAW))


def decimal_comma(c: Column) -> Column:
    """Published text: numbers get a decimal comma, empty cells become ''."""
    text = strip(c)
    return (F.when(is_blank(c, any_case=True), F.lit(""))
            .when(text.rlike(r"^[\p{Nd}.\-+ ]*\.[\p{Nd}.\-+ ]*$"), F.translate(text, ".", ","))
            .otherwise(text))


def currency_default(currency: Column, brand: Column, brand_currency: Mapping[str, str],
                     default: str) -> Column:
    """Fill an empty (or '0') currency by brand; a given one is only trimmed."""
    fallback = F.lit(default)
    for name, code in brand_currency.items():
        fallback = F.when(norm_key(brand) == name.strip().lower(), F.lit(code)).otherwise(fallback)
    return F.when(is_blank(currency, ["0"]), fallback).otherwise(strip(currency))


def netting_default(c: Column, any_case: bool = False) -> Column:
    """An empty netting flag means 'No'; a given one is only trimmed."""
    return F.when(is_blank(c, any_case=any_case), F.lit(NETTING_NO)).otherwise(strip(c))


def billing_total(netting: Column, cpa: Column, rs: Column) -> Column:
    """'No' ignores negative revenue share, 'Sí' floors the sum at zero, any other
    flag adds up; a missing amount gives 0."""
    zero = F.lit(0).cast(MONEY)
    flag = strip(netting)
    total = (F.when(flag == NETTING_NO, cpa + F.greatest(rs, zero))
             .when(flag == NETTING_YES, F.greatest(cpa + rs, zero))
             .otherwise(cpa + rs))
    known = cpa.isNotNull() & rs.isNotNull()
    return F.when(known, round2(total)).otherwise(zero)
