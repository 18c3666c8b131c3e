"""Text shaping for the report: shortened titles and formatted numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import REPORT_TITLE_CHARS


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def short_title(title, n: int = REPORT_TITLE_CHARS) -> Column:
    """First ``n`` characters followed by ``...`` (always appended)."""
    return F.concat(F.substring(_c(title), 1, n), F.lit("..."))


def thousands(c) -> Column:
    """Whole number with thousands separators: ``1,234,567``."""
    return F.format_number(_c(c), 0)


def fixed4(c) -> Column:
    """Four decimals: ``0.0375``."""
    return F.format_number(_c(c), 4)


def stamp_text(ts) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss[.ffffff]+00:00`` (UTC session)."""
    t = _c(ts)
    micros = F.unix_micros(t) % 1000000
    frac = F.when(micros != 0, F.date_format(t, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), frac, F.lit("+00:00"))
