"""Column expressions shared by the operators (all built-in, JVM-side).

Money is summed as decimals: partial sums of decimals are exact, so a total
is the same whatever order they are merged in. Results are doubles again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: label vocabulary of the data model ------------------------
PAYMENT_TYPE_LABELS = {
    "boleto": "Bank Transfer",
    "credit_card": "Credit Card",
    "debit_card": "Debit Card",
    "voucher": "Voucher",
}
PAYMENT_TYPE_OTHER = "other"
SIZE_LABELS = ("Small", "Medium", "Large", "Extra Large")
AOV_LABELS = ("Low", "Medium", "High")
NO_REVIEW = "No Review"
REVIEW_GIVEN = "Review Given"
NO_COMMENT = "No Comment"
HAS_COMMENT = "Has Comment"
NO_REVIEW_FLAG = "No Reivew"      # spelling is part of the output contract
WEEKEND, WEEKDAY = "Weekend", "Weekday"
WEEKEND_DAYS = (1, 7)             # dayofweek: Sunday=1 .. Saturday=7
SENTINEL_DATE = "1900-01-01"
SENTINEL_TIMESTAMP = "1900-01-01 00:00:00"
SENTINEL_SCORE = -1
UNKNOWN_CATEGORY = "Unknown"
HEX_ID_PATTERN = r"^[a-fA-F0-9]{32}$"
DATE_LIKE_PATTERN = r"^\d{4}-\d{2}-\d{2}.*"
# ------------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_total(c: str | Column, places: int = 2) -> Column:
    """Exact decimal total of a column of at most ``places`` decimals."""
    return F.sum(col(c).cast(f"decimal({16 + places},{places})"))


def money_sum(c: str | Column, places: int = 2) -> Column:
    """Exact total of a money column, rounded to cents."""
    return F.round(money_total(c, places), 2).cast("double")


def money_avg(c: str | Column) -> Column:
    """Mean of a two-decimal money column rounded half-up to cents; total and
    division are decimal, so ties (e.g. 10.01 / 2) always round the same."""
    return F.round(F.try_divide(money_total(c), F.count(col(c))), 2).cast("double")


def flag(cond: Column) -> Column:
    """1 when ``cond`` holds, else 0 (null counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def recode_payment_type(c: str | Column) -> Column:
    """Code -> label; anything else, null included, becomes ``other``."""
    c = col(c)
    expr = None
    for code, label in PAYMENT_TYPE_LABELS.items():
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    return expr.otherwise(PAYMENT_TYPE_OTHER)


def quartile_band(c: str | Column, q1: Column, q2: Column, q3: Column) -> Column:
    """<=q1 Small, <=q2 Medium, <=q3 Large, else Extra Large (null too)."""
    c = col(c)
    small, medium, large, xlarge = SIZE_LABELS
    return F.when(c <= q1, small).when(c <= q2, medium).when(c <= q3, large).otherwise(xlarge)


def aov_band(c: str | Column, low: Column, high: Column) -> Column:
    """>= high High; < low Low; else (null too) Medium."""
    c = col(c)
    lo, mid, hi = AOV_LABELS
    return F.when(c >= high, hi).when(c < low, lo).otherwise(mid)


def sorted_text(arr: str | Column, sep: str = ",") -> Column:
    """Array rendered as sorted, delimited text (stable for hashing/output)."""
    return F.array_join(F.sort_array(F.transform(col(arr), lambda x: x.cast("string"))), sep)


def ordered_text(arr: str | Column, sep: str = ",") -> Column:
    """Array rendered in its own element order as delimited text."""
    return F.array_join(F.transform(col(arr), lambda x: x.cast("string")), sep, "null")


def pack_id(c: str | Column) -> Column:
    """An id as bytes, for shuffles and join keys: two lowercase hex digits a
    byte where the whole id is of such digits, its UTF-8 bytes otherwise. The
    first byte tells which, so different ids never become equal. Null is the
    empty bytes, which join each other: one side must hold no null ids."""
    c = col(c)
    digits = F.when((F.octet_length(c) % 2 == 0) & (F.lower(c) == c), F.unhex(c))        # null if any is no digit
    return F.coalesce(F.concat(F.lit(b"\x01"), digits), F.concat(F.lit(b"\x00"), c.cast("binary")), F.lit(b""))


def unpack_id(c: str | Column) -> Column:
    """The id that ``pack_id`` packed."""
    c = col(c)
    tag, rest = F.substring(c, 1, 1), F.substring(c, F.lit(2), F.octet_length(c))
    return F.when(tag == F.lit(b"\x01"), F.lower(F.hex(rest))).when(tag == F.lit(b"\x00"), rest.cast("string"))


def not_sentinel(c: str | Column, sentinel: str = SENTINEL_DATE) -> Column:
    """Null out a sentinel date/timestamp so date arithmetic ignores it."""
    c = col(c)
    return F.when(F.to_date(c) != F.lit(sentinel).cast("date"), c)
