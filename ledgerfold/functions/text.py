"""Text, key and login functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["bind", "strip", "norm_key", "platform_key", "is_blank", "canonical_operator",
           "normalize_login", "safe_name", "sanitize", "base_url", "is_base_login",
           "merchant_username", "row_key", "origin", "BLANKS"]

# What counts as white space, and as an empty cell.
WHITESPACE = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
              "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
BLANKS = ["", "nan", "NaN", "None"]

# Local part, then the domain name up to its first dot unless it is gmail.
EMAIL = r"(?s)^([^@]*)@(?:(?i:gmail)(?=\.|\z)|([^.]*)).*\z"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), computing `value` once per row. Inside a higher-order function an
    outer expression would otherwise be computed anew for every element."""
    return F.transform(F.array(value), use)[0]


def strip(c: Column) -> Column:
    """Trim every kind of white space (Spark's own trim removes blanks only)."""
    return F.trim(c, F.lit(WHITESPACE))


def norm_key(c: Column) -> Column:
    """Comparison key: null becomes empty, trimmed, lower case."""
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def platform_key(c: Column) -> Column:
    """norm_key without inner spaces, so 'Income Access' meets 'IncomeAccess'."""
    return F.replace(norm_key(c), F.lit(" "), F.lit(""))


def is_blank(c: Column, extra: Iterable[str] = (), any_case: bool = False) -> Column:
    """True for null and for the texts that stand for an empty cell. Never null."""
    text = strip(c)
    values = [*BLANKS, *extra]
    if any_case:
        text, values = F.lower(text), sorted({v.lower() for v in values})
    return F.coalesce(text.isin(values), F.lit(True))


def canonical_operator(c: Column, aliases: Mapping[str, str]) -> Column:
    """Replace renamed operators; other names stay as they are, null becomes ''."""
    out = F.coalesce(c, F.lit(""))
    key = norm_key(c)
    for alias, name in aliases.items():
        out = F.when(key == alias.strip().lower(), F.lit(name)).otherwise(out)
    return out


def normalize_login(c: Column) -> Column:
    """An e-mail becomes local part + domain name up to its first dot (nothing for
    gmail); any other login is only trimmed."""
    return F.regexp_replace(strip(F.coalesce(c, F.lit(""))), EMAIL, "$1$2")


def safe_name(c: Column) -> Column:
    """A text that is safe as a file name; 'report' when nothing remains."""
    kept = F.trim(F.regexp_replace(c, r"[^A-Za-z0-9_.\-]", "_"), F.lit("_"))
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("report"))


def sanitize(c: Column) -> Column:
    """Upper case, with every other character than A-Z and 0-9 replaced by '_'."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "_")


def base_url(c: Column) -> Column:
    """scheme://host[:port] of a URL; parts that are missing stay empty."""
    url = strip(c)
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.concat(F.lower(scheme), F.lit("://"), host)


def is_base_login(sheet_user: Column, login: Column) -> Column:
    """True when `login` is `sheet_user`, or a part of it delimited by '_'."""
    padded = lambda c: F.concat(F.lit("_"), c, F.lit("_"))               # noqa: E731
    return (login != "") & F.contains(padded(sheet_user), padded(login))


def merchant_username(merchant: Column, username: Column) -> Column:
    """Last word of the merchant + '_' + username; the username without a merchant."""
    text = strip(merchant)
    last = F.element_at(F.split(text, r"(?U)\s+"), -1)
    return (F.when(F.coalesce(text, F.lit("")) == "", username)
            .otherwise(F.concat(last, F.lit("_"), username)))


def row_key(month: Column, ref: Column, platform: Column, username: Column) -> Column:
    """The four parts, trimmed, with nothing between them."""
    return F.concat_ws("", *[strip(c) for c in (month, ref, platform, username)])


def origin(operator: Column, username: Column) -> Column:
    """Trimmed operator + '_' + normalised login."""
    return F.concat_ws("_", strip(F.coalesce(operator, F.lit(""))), normalize_login(username))
