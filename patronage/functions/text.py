"""Text, key and contact normalisers as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..codes import JUNK_PHONES


def is_not_empty(c: Column) -> Column:
    """True for text with a non-blank character; never null."""
    return F.coalesce(F.length(F.trim(c.cast("string"))) > 0, F.lit(False))


def is_empty(c: Column) -> Column:
    return ~is_not_empty(c)


def blank_to_null(c: Column) -> Column:
    return F.when(is_not_empty(c), c)


def norm_text(c: Column) -> Column:
    """Lower-cased, trimmed text; blank becomes null so that it never joins."""
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def email_key(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)), F.lit(""))


# fixed values: characters that make an e-mail address invalid
EMAIL_BAD_CHARS = ["!", "#", "$", "%", "&", "'", "*", "+", "-", "/", "=", "?", "^", "`"]


def email_has_bad_chars(c: Column) -> Column:
    """True when the address holds a character that makes it invalid."""
    stripped = F.translate(c, "".join(EMAIL_BAD_CHARS), "")
    return F.coalesce(F.length(stripped) < F.length(c), F.lit(False))


def digits_to_long(c: Column) -> Column:
    """Digits of a text as a number; nothing usable gives 0."""
    digits = F.regexp_replace(c.cast("string"), "[^0-9]", "")
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def text_to_long(c: Column) -> Column:
    """Whole text as a number; null and blank give 0."""
    return F.when(is_empty(c), F.lit(0).cast("bigint")).otherwise(F.trim(c.cast("string")).try_cast("bigint"))


def valid_phone(c: Column) -> Column:
    """North-American number: 10 digits (or 11 led by 1), not one repeated digit, not junk."""
    s = digits_to_long(c).cast("string")
    right_length = (F.length(s) == 10) | ((F.length(s) == 11) & s.startswith("1"))
    return right_length & ~s.rlike(r"^(\d)\1*$") & ~s.isin(JUNK_PHONES)


def strip_brackets(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\[\]]", ""))


def strip_leading_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+", "")


def sort_key_list(c: Column, sep: str = ",") -> Column:
    """A separated list of numeric keys, sorted by number."""
    keys = F.transform(F.split(c, sep), lambda k: F.trim(k).try_cast("bigint"))
    return F.array_join(F.array_sort(keys).cast("array<string>"), sep)


def trxn_id(date: Column, store: Column, register: Column, number: Column) -> Column:
    """yyyymmdd + 5-digit store + 3-digit register + 5-digit transaction number."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat(F.date_format(date, "yyyyMMdd"), pad(store, 5), pad(register, 3), pad(number, 5))


def fixed_width(spec: list[tuple], pad: str = " ", columns: list[str] | None = None) -> Column:
    """One text line from (column, width) pairs, each value left-padded and cut at its width. A third
    item is a padding of the column's own. With `columns`, those that a frame has, others are blank."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if columns is None or c in columns else F.lit("")
    return F.concat(*[F.lpad(value(c), n, *(own or [pad])) for c, n, *own in spec])


def null_safe_hash(cols: list[Column], normalise=lambda c: F.lower(F.trim(c.cast("string")))) -> Column:
    """md5 over columns with a marker per null, so (null, 'a') and ('a', null) differ."""
    marked = [F.coalesce(F.concat(F.lit("="), normalise(c)), F.lit("~")) for c in cols]
    return F.md5(F.concat_ws("\u0001", *marked))


def normalize_flag(c: Column, values: dict[str, str] | None = None) -> Column:
    """Decode free-text flags: blank to null, known spellings to their word, the rest unchanged."""
    values = values or {"y": "YES", "yes": "YES", "1": "YES", "n": "NO", "no": "NO", "0": "NO",
                        "unknown": "UNKNOWN"}
    key = F.lower(F.trim(c))
    out = F.when(is_empty(c), F.lit(None).cast("string"))
    for k, v in values.items():
        out = out.when(key == k, v)
    return out.otherwise(c)


def decode(c: Column, values: dict, default=None) -> Column:
    """Chained when over a small fixed table."""
    out = None
    for k, v in values.items():
        out = (F if out is None else out).when(c == k, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def amount_from_cents(cents: Column, sign: Column) -> Column:
    """Unsigned cents text with a separate sign to an exact amount."""
    value = cents.cast("decimal(12,0)") / F.lit(100).cast("decimal(3,0)")
    return F.when(sign == "-", -value).otherwise(value).cast("decimal(10,2)")
