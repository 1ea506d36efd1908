"""Dates and times of publication, folders and ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import text_of
from tidemark.functions.urls import url_date

# Spanish months, fixed values.
MONTHS = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
_SPANISH = r"(?i)\b(\d{1,2})\s+(" + "|".join(MONTHS) + r"),?\s+(\d{4})\b"
_CLOCK = r"\b(\d{1,2}:\d{2}(?::\d{2})?)\b"
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}|$)"


def _clock(c: Column) -> Column:
    """``HH:mm:ss`` of a written time, null if it is none."""
    h, m, s = (F.regexp_extract(c, r"^(\d{1,2}):(\d{2})(?::(\d{2}))?$", k) for k in (1, 2, 3))
    text = F.format_string("%s:%s:%s", F.lpad(h, 2, "0"), m, F.when(s == "", "00").otherwise(s))
    return F.when((h != "") & (h.try_cast("int") < 24) & (m.try_cast("int") < 60) & (F.coalesce(s.try_cast("int"), F.lit(0)) < 60), text)


def publication(c: Column | str, zone: str = "America/Santiago") -> Column:
    """``day date, clock string`` of a written publication time; null if it isn't understood.

    Spanish dates (with or without a time), ISO dates and ISO times; a time with an offset
    is moved to ``zone``. ``clock`` is empty where no time is given.
    """
    c = F.trim(text_of(c))
    month = F.coalesce(*(F.when(F.lower(F.regexp_extract(c, _SPANISH, 2)) == n, F.lit(k)) for n, k in MONTHS.items()))
    day = F.try_make_timestamp(F.regexp_extract(c, _SPANISH, 3).try_cast("int"), month, F.regexp_extract(c, _SPANISH, 1).try_cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast("date")
    written = F.regexp_extract(c, _CLOCK, 1)
    spanish = F.when(day.isNotNull() & ((written == "") | _clock(written).isNotNull()), F.struct(day.alias("day"), F.coalesce(_clock(written), F.lit("")).alias("clock")))
    only = F.when(F.length(c) == 10, F.struct(c.try_cast("date").alias("day"), F.lit("").alias("clock")))
    offset = c.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & (F.length(c) > 16)
    moved = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(c.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz"))
    stamp = F.when(offset, moved).otherwise(F.regexp_replace(c, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz"))
    full = F.when(stamp.isNotNull(), F.struct(stamp.cast("date").alias("day"), F.date_format(stamp, "HH:mm:ss").alias("clock")))
    iso = F.when(c.rlike(_ISO), F.when(F.length(c) == 10, F.when(c.try_cast("date").isNotNull(), only)).otherwise(full))
    return F.when(c.rlike(_SPANISH), spanish).otherwise(iso)


def corrected(candidates: list[Column | str], url: Column | str) -> Column:
    """``day, clock, basis``: the first publication that is understood, else the date in the address, else null."""
    found = F.coalesce(*(publication(c) for c in candidates))
    day = url_date(url)
    return F.when(found.isNotNull(), F.struct(found["day"].alias("day"), found["clock"].alias("clock"), F.lit("published").alias("basis"))).when(day.isNotNull(), F.struct(day.alias("day"), F.lit("").alias("clock"), F.lit("url_fallback").alias("basis")))


def article_clock(published_time: Column | str, published_at: Column | str) -> Column:
    """``HH:mm:ss`` at which an article came out, from its time or the part after ``T`` of its time stamp; null if unknown."""
    t = F.trim(text_of(published_time))
    after = F.regexp_extract(F.trim(text_of(published_at)), r"T([^+-]*)", 1)
    return F.coalesce(_clock(F.left(t, F.lit(8))), _clock(F.left(t, F.lit(5))), _clock(F.left(F.trim(after), F.lit(8))), _clock(F.left(F.trim(after), F.lit(5))))


def any_date(c: Column | str, formats: tuple[str, ...] = ("yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", "dd_MM_yyyy")) -> Column:
    """The first format that fits, else null."""
    c = F.trim(text_of(c))
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats))


def folder_of(day: Column | str) -> Column:
    return F.date_format(day, "dd_MM_yyyy")


def folder_date(c: Column | str) -> Column:
    c = text_of(c)
    return F.when(c.rlike(r"^\d{2}_\d{2}_\d{4}$"), F.try_to_timestamp(c, F.lit("dd_MM_yyyy")).cast("date"))


def parse_date(value: str) -> date:
    """A date that a user wrote."""
    for f in ("%Y-%m-%d", "%d-%m-%Y", "%d/%m/%Y", "%d_%m_%Y"):
        try:
            return datetime.strptime(value.strip(), f).date()
        except ValueError:
            continue
    raise ValueError(f"no date: {value!r}; write YYYY-MM-DD, DD-MM-YYYY, DD/MM/YYYY or DD_MM_YYYY")


def parse_time(value: str) -> str:
    """A time that a user wrote, as ``HH:mm:ss``."""
    for f in ("%H:%M", "%H:%M:%S"):
        try:
            return datetime.strptime(value.strip(), f).strftime("%H:%M:%S")
        except ValueError:
            continue
    raise ValueError(f"no time: {value!r}; write HH:MM")


def days_back(end: date, count: int) -> list[date]:
    return [end - timedelta(days=k) for k in range(count)]


def ranges(start: date, end: date, most: int = 31) -> list[tuple[date, date]]:
    """Consecutive ranges of at most ``most`` days, both ends in; the last may be shorter."""
    out = []
    while start <= end:
        stop = min(end, start + timedelta(days=most - 1))
        out.append((start, stop))
        start = stop + timedelta(days=1)
    return out


def ranges_column(start: Column, end: Column, most: int = 31) -> Column:
    """:func:`ranges` as an array of structs."""
    starts = F.sequence(start, end, F.expr(f"interval {most} days"))
    return F.when(start <= end, F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.date_add(s, most - 1), end).alias("end")))).otherwise(F.array())
