"""Column functions for the scalar expressions of the sync jobs.

All are built-in Spark expressions (JVM side, inside whole-stage codegen); none
reads the wall clock: ``as_of`` and ``now`` are always parameters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import STATUSES


def col_or_lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from a date / datetime / ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(as_of, days_back: int = 0) -> Column:
    """Midnight of ``as_of - days_back`` (``CONVERT(DATETIME, CONVERT(VARCHAR, d, 106))``)."""
    if isinstance(as_of, Column):
        return F.date_sub(F.to_date(as_of), days_back).cast("timestamp_ntz")
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of[:10])
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return ts_lit(as_of - dt.timedelta(days=days_back))


def dmy(c) -> Column:
    """``CONVERT(VARCHAR(10), dt, 103)``: ``dd/MM/yyyy``."""
    return F.date_format(c, "dd/MM/yyyy")


def truncate_text(c, n: int) -> Column:
    """``CONVERT(VARCHAR(n), s)`` cuts silently; a Spark cast to ``varchar(n)`` does not."""
    return F.left(c if isinstance(c, Column) else F.col(c), F.lit(n))


def zero_pad(c, width: int) -> Column:
    """``RIGHT('000…' + CAST(c AS VARCHAR), width)``: keeps the right-most digits on
    overflow (``lpad`` would keep the left ones)."""
    c = c if isinstance(c, Column) else F.col(c)
    return F.right(F.concat(F.lit("0" * width), c.cast("string")), F.lit(width))


def concat_text(*cols) -> Column:
    """``CONCAT`` that treats NULL as empty text (Spark's ``concat`` returns NULL)."""
    return F.concat_ws("", *[col_or_lit(c) for c in cols])


def decimal_text(c) -> Column:
    """``CONVERT(VARCHAR(25), decimal)``: keeps the scale (``10000.50``)."""
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def add_seconds(ts, n) -> Column:
    return F.timestamp_add("SECOND", col_or_lit(n), ts if isinstance(ts, Column) else F.col(ts))


def add_days(ts, n) -> Column:
    return F.timestamp_add("DAY", col_or_lit(n), ts if isinstance(ts, Column) else F.col(ts))


# Fixed values of the portable pseudo-random integer (any SQL engine computes it the
# same way, with no 64-bit overflow): modulus 2^31 - 1, multiplier 1000003, salt step 7919.
RAND_MOD = 2147483647
RAND_MUL = 1000003
RAND_SALT = 7919


def rand_int(k: int, seed: int, n, salt: int) -> Column:
    """Reproducible pseudo-random integer in ``[0, k)`` for row number ``n`` (>= 0) and
    a per-column ``salt``: ``((n mod M) * A + salt * S + seed) mod M mod k``."""
    n = col_or_lit(n)
    h = F.pmod(F.pmod(n, F.lit(RAND_MOD)) * F.lit(RAND_MUL) + F.lit(salt * RAND_SALT + seed), F.lit(RAND_MOD))
    return F.pmod(h, F.lit(k))


def rand_int_sql(k: int, seed: int, n: str, salt: int) -> str:
    """The same value as SQL text (for the oracle), ``n`` a non-negative integer expression."""
    return f"((({n}) % {RAND_MOD}) * {RAND_MUL} + {salt * RAND_SALT + seed}) % {RAND_MOD} % {k}"


def minutes_since(completed, now) -> Column:
    """Fractional minutes from ``completed`` to ``now``; NULL in, NULL out."""
    completed = completed if isinstance(completed, Column) else F.col(completed)
    return F.timestamp_diff("MICROSECOND", completed, ts_lit(now)) / F.lit(60_000_000.0)


def is_healthy(completed, status, threshold_minutes, now) -> Column:
    """Healthy: completed, status present and not ``Failed`` (any case), and recent
    (minutes ``<=`` threshold, inclusive).  Never NULL."""
    completed = completed if isinstance(completed, Column) else F.col(completed)
    status = status if isinstance(status, Column) else F.col(status)
    ok = (completed.isNotNull() & status.isNotNull() & (status != F.lit(""))
          & (F.lower(status) != F.lit("failed"))
          & (minutes_since(completed, now) <= col_or_lit(threshold_minutes)))
    return F.coalesce(ok, F.lit(False))


def age_text(minutes) -> Column:
    """``never`` / ``just now`` / ``N min ago`` / ``H.H hr ago``."""
    m = minutes if isinstance(minutes, Column) else F.col(minutes)
    return (F.when(m.isNull(), "never")
            .when(m < 1, "just now")
            .when(m < 60, F.concat(F.round(m, 0).cast("bigint").cast("string"), F.lit(" min ago")))
            .otherwise(F.concat(F.format_string("%.1f", m / 60.0), F.lit(" hr ago"))))


def range_text(lo, hi) -> Column:
    """``from–to`` with a dash for a missing start; a zero or NULL end prints nothing."""
    lo = lo if isinstance(lo, Column) else F.col(lo)
    hi = hi if isinstance(hi, Column) else F.col(hi)
    head = F.coalesce(lo.cast("string"), F.lit("—"))
    tail = F.when(hi.isNotNull() & (hi != 0), F.concat(F.lit("–"), hi.cast("string"))).otherwise("")
    return F.concat(head, tail)


def ratio_text(inserted, read) -> Column:
    return F.concat_ws("/", F.col(inserted).cast("string") if isinstance(inserted, str) else inserted,
                       F.col(read).cast("string") if isinstance(read, str) else read)


def seconds_text(d) -> Column:
    d = d if isinstance(d, Column) else F.col(d)
    # format_string turns NULL into text ("nu"), so NULL is handled first
    return F.concat(F.when(d.isNull(), F.lit("—")).otherwise(F.format_string("%.2f", d)), F.lit(" s"))


def first_line(msg) -> Column:
    """First line of an error text, a dash when empty."""
    msg = msg if isinstance(msg, Column) else F.col(msg)
    return F.when(msg.isNull() | (msg == ""), F.lit("—")).otherwise(
        F.split_part(msg, F.lit("\n"), F.lit(1)))


def valid_status(status) -> Column:
    status = status if isinstance(status, Column) else F.col(status)
    return status.isin(*STATUSES)
