"""Column functions (scalar expressions, all JVM-side).

Rounding follows one rule everywhere: half away from zero on the exact
decimal value. Ratios of integers are rounded with integer arithmetic so the
result does not depend on summation order or on binary float ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values of the reference's surrogate-key macro (dbt_utils 1.3.0).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """``round(x, digits)`` of a double, taken on its decimal value.

    ``round(1.005, 2)`` is 1.01 here whatever the binary value of 1.005 is.
    """
    return F.round(_col(c).cast(DecimalType(38, 9)), digits).cast("double")


def idiv(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative longs."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def round_ratio_units(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``round(num / den, digits) * 10**digits`` as a long, for integer num, den.

    Half away from zero, exact; NULL when ``den`` is 0 or NULL.
    """
    scale = 10**digits
    if isinstance(num, str) and isinstance(den, str):
        # Same arithmetic as SQL text: one JVM call instead of about twenty.
        sv = f"(cast(`{num}` as bigint) * {scale})"
        dv = f"cast(`{den}` as bigint)"
        q = f"((abs({sv}) * 2 + abs({dv})) div (abs({dv}) * 2))"
        return F.expr(f"case when {dv} != 0 then (case when ({sv} < 0) != ({dv} < 0) then -{q} else {q} end) end")
    s = _col(num).cast("long") * F.lit(scale)
    d = _col(den).cast("long")
    q = idiv(F.abs(s) * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when((s < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, signed)


def round_ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``round(num / den, digits)`` as a double (see ``round_ratio_units``)."""
    return round_ratio_units(num, den, digits) / F.lit(float(10**digits))


def pct_change_units(cur: Column | str, prev: Column | str, digits: int = 2) -> Column:
    """Percent change ``(cur - prev) * 100 / prev`` in units of 10**-digits.

    NULL when ``prev`` is 0 or NULL; ``cur`` NULL counts as 0.
    """
    c = F.coalesce(_col(cur).cast("long"), F.lit(0))
    p = F.coalesce(_col(prev).cast("long"), F.lit(0))
    return F.when(p != 0, round_ratio_units((c - p) * 100, p, digits))


def pct_change(cur: Column | str, prev: Column | str, digits: int = 2) -> Column:
    return pct_change_units(cur, prev, digits) / F.lit(float(10**digits))


def cents_to_dollars(c: Column | str, decimal_places: int = 2) -> Column:
    """Integer cents to a dollar amount rounded to ``decimal_places``.

    Whole cents below 2^53 divided by 100 are the nearest double of their two
    decimals, so only fewer places or larger amounts need decimal arithmetic.
    """
    cents = _col(c)
    exact = F.round(cents.cast(DecimalType(38, 2)) / F.lit(100), decimal_places).cast("double")
    if decimal_places < 2:
        return exact
    whole = (cents == F.floor(cents)) & (F.abs(cents) < F.lit(1 << 53))
    return F.when(whole, cents / F.lit(100.0)).otherwise(exact)


def money(c: Column | str, scale: int = 4) -> Column:
    """A money amount as an exact decimal, for order-independent sums."""
    return _col(c).cast(DecimalType(18, scale))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the '-'-joined string values, NULL replaced by a marker."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def coded_id(prefix: str, n: Column | str, width: int = 6) -> Column:
    """'cust000042'-style identifiers for non-negative n; wider numbers are
    kept whole, never truncated (lpad to max(width, digits))."""
    digits = _col(n).cast("long").cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def add_days(start: str, days: Column) -> Column:
    """``date 'start' + days``."""
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def add_minutes(ts: Column, minutes: Column) -> Column:
    """``ts + interval minutes minute`` on timestamp_ntz."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def true_or_false(cond: Column) -> Column:
    """``case when cond then true else false end`` (NULL -> false)."""
    return F.coalesce(cond, F.lit(False))
