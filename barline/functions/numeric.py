"""Numeric cleaning and division helpers as Catalyst expressions.

ANSI mode (the Spark 4 default) raises on ``x / 0``, so every ratio goes
through ``try_divide`` or an explicit rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")

# Text accepted by a decimal float parser: digits with optional single
# underscores between them, optional fraction and exponent, optional sign.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_TEXT = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
PLAIN = r"[0-9]+"
PLAIN_TEXT = rf"^[+-]?(?:{PLAIN}(?:\.(?:{PLAIN})?)?|\.{PLAIN})(?:[eE][+-]?{PLAIN})?$"
BLANKS = " \t\n\x0b\f\r"
INF_TEXT = r"^[+-]?(?:INF|INFINITY)$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(text: Column) -> Column:
    """Text without white space (blanks, tabs, line ends) at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def parse_float(text: Column, pattern: str = FLOAT_TEXT) -> Column:
    """Strict float parse of already upper-cased text; unparsable → null.

    ``nan`` is treated as missing (null); ``inf``/``infinity`` parse to ±inf.
    """
    t = strip(text)
    number = F.when(
        t.rlike(pattern), F.translate(t, "_", "").try_cast("double")
    )
    inf = F.when(t.rlike(INF_TEXT), F.when(t.startswith("-"), F.lit(-INF)).otherwise(F.lit(INF)))
    return F.coalesce(number, inf)


def clean_numeric(x: str | Column) -> Column:
    """Messy price/volume text → double.

    Rules: drop ``$``, ``,`` and ``"``; trim; upper-case; a text containing
    ``M`` anywhere means millions (every M removed), else ``B`` means billions,
    else a ``%`` is removed; anything that does not then parse is null.
    """
    # character deletions are plain translate/replace calls, not regex scans
    s = F.upper(strip(F.translate(_c(x).cast("string"), '$,"', "")))
    has_m, has_b = s.contains("M"), s.contains("B")
    none = F.lit("")
    body = (F.when(has_m, F.replace(s, F.lit("M"), none))
            .when(has_b, F.replace(s, F.lit("B"), none))
            .otherwise(F.replace(s, F.lit("%"), none)))
    scale = F.when(has_m, F.lit(1_000_000.0)).when(has_b, F.lit(1_000_000_000.0)).otherwise(F.lit(1.0))
    # one parse of the branch-specific text (x·1.0 is exact, so the plain branch is unchanged)
    return F.when(s.isNotNull(), parse_float(body) * scale)


def to_numeric(x: str | Column, data_type=None) -> Column:
    """P10, ``to_numeric(errors="coerce")``: numbers pass through as double; text
    must be a plain decimal without underscores (surrounding white space allowed) or ±inf, else null."""
    from pyspark.sql.types import NumericType

    if isinstance(data_type, NumericType):
        return _c(x).cast("double")
    return parse_float(F.upper(_c(x).cast("string")), PLAIN_TEXT)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den with float semantics: x/0 → ±inf, 0/0 → null (NaN is missing)."""
    n, d = _c(num), _c(den)
    by_zero = F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))
    return F.when(d == 0, by_zero).otherwise(F.try_divide(n, d))


def ratio_or_null(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is 0 (denominator replaced by missing)."""
    return F.try_divide(_c(num), F.when(_c(den) != 0, _c(den)))


def natural_log(x: str | Column) -> Column:
    """ln with float semantics: ln(0) = -inf, ln(inf) = inf, ln(<0) → null."""
    v = _c(x)
    return F.when(v == 0, F.lit(-INF)).when(v > 0, F.ln(v))
