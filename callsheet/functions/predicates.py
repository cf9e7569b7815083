"""Row predicates of the campaign rules.  SQL three-valued logic throughout:
a predicate over a NULL yields NULL and the row is dropped by ``filter``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsheet import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_portfolios(portfolios: Iterable[int] | None, col: str = "cod_cli") -> Column:
    """Portfolio filter; ``None`` means every portfolio (NULL codes still drop)."""
    if portfolios is None:
        return F.col(col).isNotNull()
    return F.col(col).isin([int(p) for p in portfolios])


def not_like(c, text: str, case_insensitive: bool = False) -> Column:
    """``c NOT LIKE '%text%'``; NULL stays NULL."""
    c = _c(c)
    if case_insensitive:
        return ~F.lower(c).contains(text.lower())
    return ~c.contains(text)


def usable_phone(obs="obs", status="status", ddd="dddfone", tel="telefone", case_insensitive: bool = False) -> Column:
    """The phone usability rule.

    Notes saying unknown/incorrect always disqualify; "disconnected"-like
    notes disqualify unless the status is a good one; the number (area code
    + number) must have at least 8 bytes and no ``X``.  A NULL note drops
    the phone (three-valued logic).
    """
    obs, status = _c(obs), _c(status)
    number = F.concat(_c(ddd), _c(tel))
    always_bad = [not_like(obs, t, case_insensitive) for t in K.NOTE_ALWAYS_BAD]
    soft_bad = [not_like(obs, t, case_insensitive) for t in K.NOTE_BAD_UNLESS_GOOD_STATUS]
    pred = always_bad[0]
    for p in always_bad[1:]:
        pred = pred & p
    soft = soft_bad[0]
    for p in soft_bad[1:]:
        soft = soft & p
    return (
        pred
        & (status.isin(K.PHONE_GOOD_STATUSES) | soft)
        & (F.octet_length(number) >= K.NUMBER_MIN_BYTES)
        & not_like(number, K.NUMBER_BAD_CHAR, case_insensitive)
    )


def created_since(c, since: dt.date | str) -> Column:
    """``c >= since`` at midnight (timestamps compared with a date literal)."""
    return _c(c) >= F.lit(str(since)).cast("timestamp_ntz")


def recent_since(c, as_of: dt.date | str | None = None, days: int = K.NEVER_CONTACTED_DAYS) -> Column:
    """``c >= as_of - days`` (no upper bound); ``as_of`` defaults to today."""
    base = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return _c(c) >= F.date_sub(base, days).cast("timestamp_ntz")


def day_since(c, as_of: dt.date | str | None = None, days: int = K.NEVER_CONTACTED_DAYS) -> Column:
    """The same rule for a column of days."""
    base = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return _c(c) >= F.date_sub(base, days)
