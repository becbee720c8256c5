"""Date operators (D1-D9). Every result is TIMESTAMP_NTZ; anything unparseable is NULL.

Offsets are dropped without conversion (the sink stores naive wall-clock time),
so ``2026-06-27T10:00-05:00`` is 10:00. Epoch inputs are read in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.sqlexpr import bound
from hirewire.functions.text import col_, py_strip

# The ISO shapes Python's ``fromisoformat`` accepts: a calendar date (extended or basic) or a
# week date, then an optional time (extended or basic) and offset. Spark's own cast alone
# would also take ``2026`` or ``2026-06``, which must stay NULL, so the pieces are matched
# here and re-assembled into the one canonical form the cast reads.
_ISO_RE = (r"^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})-?W(\d{2})(?:-?([1-7]))?)"
           r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.(\d+))?)?)?)?"
           r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?$")


def _week_date(year: Column, week: Column, day: Column) -> Column:
    """ISO week date -> date; NULL when the week does not exist in that year."""
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    monday1 = F.date_sub(jan4, F.weekday(jan4))
    d = F.date_add(monday1, (week - 1) * 7 + day - 1)
    return F.when(week.between(1, 53) & (F.weekofyear(d) == week), d)


# The usual shape, whose first group can be cast as it is.
_PLAIN_ISO_RE = r"^(\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)?)(?:Z|[+-]\d{2}:?\d{2})?\z"
# All groups of the pattern from one match; what follows the last mark is no part of it.
_ISO_PARTS = "|".join(f"${i}" for i in range(1, 14)) + "|"


def iso_naive(c) -> Column:
    """ISO-8601 text (``Z`` allowed) -> naive wall-clock timestamp, offset dropped. Texts of the usual shape don't get
    as far as the parts of the others."""
    plain = lambda s: F.regexp_extract(s, _PLAIN_ISO_RE, 1).try_cast("timestamp_ntz")
    return bound(col_(c), lambda s: F.coalesce(plain(s), _iso_any(s)))


def _iso_any(s: Column) -> Column:
    return F.when(s.rlike(_ISO_RE), bound(F.split(F.regexp_replace(s, _ISO_RE, _ISO_PARTS), r"\|"), _of_parts))


def _of_parts(parts: Column) -> Column:
    part = lambda i: F.get(parts, i - 1)
    two = lambda x: F.when(x == "", F.lit("00")).otherwise(x)
    dash = lambda a, b, cc: F.concat(part(a), F.lit("-"), part(b), F.lit("-"), part(cc))
    week = _week_date(part(7).try_cast("int"), part(8).try_cast("int"),
                      F.when(part(9) == "", F.lit(1)).otherwise(part(9).try_cast("int")))
    date = (F.when(part(1) != "", dash(1, 2, 3)).when(part(4) != "", dash(4, 5, 6))
            .otherwise(F.date_format(week, "yyyy-MM-dd")))
    frac = F.substring(part(13), 1, 6)
    text = F.concat(date, F.lit(" "), two(part(10)), F.lit(":"), two(part(11)), F.lit(":"), two(part(12)),
                    F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")))
    return text.try_cast("timestamp_ntz")


def ymd_prefix(c) -> Column:
    """``strptime(value[:10], '%Y-%m-%d')`` (month and day may have one digit)."""
    head = F.substring(col_(c), 1, 10)
    ok = head.rlike(r"^\d{4}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12]\d|0[1-9]|[1-9])$")
    return F.when(ok, F.try_to_timestamp(head, F.lit("yyyy-M-d")).cast("timestamp_ntz"))


def iso_or_prefix(c) -> Column:
    """ISO first, else the first ten characters as ``%Y-%m-%d``."""
    return F.coalesce(iso_naive(c), ymd_prefix(c))


def epoch_millis_local(ms) -> Column:
    """Epoch milliseconds -> naive time in the pinned (UTC) session zone."""
    micros = F.round(col_(ms).cast("double") * 1000).cast("long")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def epoch_auto(v) -> Column:
    """Seconds, or milliseconds when the value exceeds 1e12; numeric text allowed; UTC."""
    d = col_(v).try_cast("double")
    secs = F.when(d > 1e12, d / 1000.0).otherwise(d)
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(secs) < 2.5e11)
    return F.when(ok, F.timestamp_micros(F.round(secs * 1e6).cast("long")).cast("timestamp_ntz"))


def relative_posted(c, run_ts) -> Column:
    """D3: 'today' / 'yesterday' / 'N days' / 'N months' (30 days each) before ``run_ts``."""
    s = col_(c)
    t = F.lower(s)
    run_ts = col_(run_ts)
    n_day = F.regexp_extract(t, r"(\d+)\+?\s*day", 1)
    n_mon = F.regexp_extract(t, r"(\d+)\+?\s*month", 1)
    days = lambda n: F.make_dt_interval(days=n.cast("int"))
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("timestamp_ntz"))
            .when(t.contains("today"), run_ts)
            .when(t.contains("yesterday"), run_ts - F.make_dt_interval(days=F.lit(1)))
            .when(n_day != "", run_ts - days(n_day))
            .when(n_mon != "", run_ts - days(F.try_multiply(n_mon.cast("int"), F.lit(30)))))


def multi_format(c) -> Column:
    """Five layouts tried in order on the stripped text."""
    s = py_strip(col_(c))
    tries = [F.try_to_timestamp(s, F.lit(fmt)) for _, fmt in dims.DATE_FORMATS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def staleness_keep(posted, run_ts, days: int = dims.STALENESS_DAYS) -> Column:
    """Keep unless ``posted < run_ts - days``; NULL dates pass, equality passes."""
    posted = col_(posted)
    cutoff = col_(run_ts) - F.make_dt_interval(days=F.lit(days))
    return posted.isNull() | (posted >= cutoff)
