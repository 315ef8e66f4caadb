"""Images by size and times with a zone, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hosts whose addresses carry the size of an image (fixed values).
SIZED_HOSTS = ("blogger.googleusercontent.com", "1.bp.blogspot.com", "2.bp.blogspot.com", "3.bp.blogspot.com", "4.bp.blogspot.com")
#: Sizes asked for (fixed values).
SMALL, LARGE = "s320-c", "w1200-h800"
_DIGITS = "0123456789"
_SUFFIX = "abcdefghijklmnopqrstuvwxyz0123456789-"


def _number_and_rest(segment: Column) -> tuple[Column, Column]:
    """Whether a segment begins with s and a number up to its first hyphen, and what stands behind that hyphen (null: no hyphen)."""
    head = F.substring_index(segment, "-", 1)
    number = F.substr(head, F.lit(2))
    rest = F.when(F.contains(segment, F.lit("-")), F.substr(segment, F.length(head) + 2))
    return F.startswith(head, F.lit("s")) & (number != "") & (F.translate(number, _DIGITS, "") == ""), rest


def thumbnail(url: Column) -> Column:
    """The address with each segment that asks for a size, alone or with a letter behind a hyphen, asking for SMALL; null unless https."""

    def small(segment: Column) -> Column:
        number, rest = _number_and_rest(segment)
        return number & (rest.isNull() | ((F.length(rest) == 1) & rest.between("a", "z")))

    parts = F.split(url, "/")
    inner = F.transform(parts, lambda x, i: F.when((i > 0) & (i < F.size(parts) - 1) & small(x), SMALL).otherwise(x))
    return F.when(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) == "https", F.array_join(inner, "/"))


def large_image(url: Column) -> Column:
    """Addresses on SIZED_HOSTS ask for LARGE, in a segment or behind the last equals sign of the path; query, fragment and others stay."""

    def sized(segment: Column) -> Column:
        number, rest = _number_and_rest(F.lower(segment))
        return number & (rest.isNull() | ((rest != "") & (F.translate(rest, _SUFFIX, "") == "")))

    path = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    rest = F.substr(url, F.length(path) + 1)
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    asked = F.substring_index(last, "=", -1)
    tail = F.when(F.contains(last, F.lit("=")) & sized(asked), F.concat(F.substr(last, F.lit(1), F.length(last) - F.length(asked)), F.lit(LARGE))).otherwise(last)
    inner = F.transform(parts, lambda x, i: F.when(i == F.size(parts) - 1, tail).when((i > 0) & sized(x), LARGE).otherwise(x))
    known = F.lower(F.try_parse_url(url, F.lit("HOST"))).isin(*SIZED_HOSTS)
    return F.when(F.coalesce(known, F.lit(False)), F.concat(F.array_join(inner, "/"), rest)).otherwise(url)


def widest(srcset: Column, plain: Column) -> Column:
    """The address of the widest candidate of a srcset, else the plain one; candidates without a width count as 0."""
    parts = F.transform(F.split(F.coalesce(srcset, F.lit("")), ","), lambda c: F.split(F.trim(c), r"\s+"))
    width = lambda p: F.coalesce(F.try_to_number(F.regexp_extract(F.element_at(p, -1), "^([0-9]{1,9})w$", 1), F.lit("999999999")).cast("long"), F.lit(0).cast("long"))
    found = F.filter(F.transform(parts, lambda p: F.struct(width(p).alias("width"), F.get(p, F.lit(0)).alias("url"))), lambda c: c["url"] != "")
    return F.coalesce(F.array_max(found)["url"], plain)


def utc_iso(ts: Column) -> Column:
    """A moment as 2026-01-31T18:05:00Z, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def zoned_time(text: Column) -> Column:
    """The moment of an ISO text that names its zone; null without a zone or a valid time."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ].*(?:Z|[+-][0-9]{2}:?[0-9]{2})$"), F.try_to_timestamp(text))
