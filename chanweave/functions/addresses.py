"""Addresses of streams, recorded probe outcomes, timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import strip

LINE_END = "\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"
HTTP = r"^https?://"


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_rtp(url: Column | str) -> Column:
    return F.lower(F.coalesce(_column(url), F.lit(""))).startswith("rtp://")


def selection_key(standard_name: str = "standard_name", name: str = "name") -> Column:
    return F.coalesce(F.when(F.col(standard_name) != "", F.col(standard_name)), F.col(name), F.lit("?"))


def is_valid_url(url: Column | str) -> Column:
    """Scheme and host are there."""
    return F.coalesce(_column(url), F.lit("")).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")


def first_segment_url(url: Column | str, body: Column | str) -> Column:
    """First line of a playlist body that is no comment, made absolute; null if there is none."""
    lines = F.transform(F.split(F.coalesce(_column(body), F.lit("")), LINE_END), strip)
    line = F.try_element_at(F.filter(lines, lambda x: (x != "") & ~x.startswith("#")), F.lit(1))
    folder = F.regexp_replace(_column(url), "/[^/]*$", "")
    return F.when(line.rlike(HTTP), line).otherwise(F.concat(folder, F.lit("/"), F.regexp_replace(line, "^/+", "")))


def probe_status(head: str, get: str, url: str, body: str, segment: str, timed_out: str, error: str) -> Column:
    """Status of a recorded probe: requests are tried in order, the first that fails tells.

    Reading the body is a part of its request: without a body, a timeout or an error tells.
    """
    broken = F.col(body).isNull() & (F.col(head) == 200) & (F.col(get) == 200)
    failed = lambda c: F.col(c).isNotNull() & (F.col(c) != 200)
    return (
        F.when(failed(head), F.concat(F.lit("HTTP "), F.col(head)))
        .when(F.col(head).isNotNull() & failed(get), F.concat(F.lit("HTTP "), F.col(get)))
        .when(broken & F.coalesce(F.col(timed_out), F.lit(False)), "timeout")
        .when(broken & (F.coalesce(F.col(error), F.lit("")) != ""), "error")
        .when((F.col(head) == 200) & (F.col(get) == 200) & first_segment_url(url, body).isNull(), "no_segment")
        .when((F.col(head) == 200) & (F.col(get) == 200) & (F.col(segment) == 200), "ok")
        .when((F.col(head) == 200) & (F.col(get) == 200) & failed(segment), F.concat(F.lit("seg_HTTP "), F.col(segment)))
        .when(F.coalesce(F.col(timed_out), F.lit(False)), "timeout")
        .otherwise("error")
    )


def run_timestamp(utc: Column | str) -> Column:
    """Wall clock at UTC+8."""
    return F.date_format(F.from_utc_timestamp(_column(utc), "+08:00"), "yyyy-MM-dd HH:mm:ss")


def is_timestamp(x: Column | str) -> Column:
    return F.try_to_timestamp(_column(x), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
