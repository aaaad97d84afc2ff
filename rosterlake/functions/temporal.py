"""Column expressions over dates and times."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

_QUOTED = re.compile("'[^']*'")


def _where_it_may_fit(text: Column, fmt: str, parsed: Column) -> Column:
    """``parsed`` where the text holds the format's separators, else null; without them the format cannot fit.

    A text that does not fit costs an exception inside the parser, far more than a look for a character.
    """
    marks = sorted(set(re.sub(r"[A-Za-z\[\]#{}']", "", _QUOTED.sub("", fmt))))
    return F.when(reduce(and_, [F.contains(text, F.lit(m)) for m in marks]), parsed) if marks else parsed


def parse_date(text: Column, formats: Sequence[str]) -> Column:
    """Date by the first format that fits; null when none does.

    Two-digit years from 69 on belong to the last century, which Spark would put in this one.
    """
    parsed = []
    for fmt in formats:
        day = _where_it_may_fit(text, fmt, F.try_to_date(text, fmt))
        if "yy" in fmt and "yyyy" not in fmt:
            day = F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)
        parsed.append(day)
    return F.coalesce(*parsed)


def parse_timestamp(text: Column, formats: Sequence[str]) -> Column:
    """Zone-free timestamp by the first format that fits; null when none does."""
    return F.coalesce(
        *[_where_it_may_fit(text, fmt, F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")) for fmt in formats]
    )


def add_hours(ts: Column, hours: Column, sign: int = 1) -> Column:
    """Shift a timestamp by fractional hours."""
    zero = F.lit(0)
    seconds = (hours * F.lit(3600 * sign)).cast("decimal(18,6)")
    return ts + F.make_dt_interval(zero, zero, zero, seconds)


def iso_weekday(day: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(day) + F.lit(1)
