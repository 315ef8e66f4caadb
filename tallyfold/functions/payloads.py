"""Parsers of landed payloads: structured data in pages, script literals, indexed arrays, sitemaps, written dates."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import each

#: French month names, accents folded (fixed values).
MONTHS = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")
#: Tags of an indexed payload that only wrap another value (fixed values).
WRAPPERS = ("ShallowReactive", "Reactive", "Ref", "Date")


def _walk(node: object) -> Iterator[dict]:
    """Objects of a JSON-LD document breadth first: list items, then what @graph holds."""
    queue = list(node) if isinstance(node, list) else [node]
    for item in queue:
        if isinstance(item, dict):
            yield item
            queue += item["@graph"] if isinstance(item.get("@graph"), list) else []


def linked_events(page: str, kind: str = "Event") -> list[str]:
    """Objects of one @type in the page's JSON-LD scripts, as JSON; broken scripts are passed over."""
    out = []
    for body in re.findall(r'(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script\s*>', page):
        try:
            out += [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in _walk(json.loads(body)) if x.get("@type") == kind]
        except ValueError:
            continue
    return out


def json_ld(page: Column | str, kind: str = "Event") -> Column:
    """array<string> of linked_events; null pages give an empty array."""

    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        return each(pages, lambda p: linked_events(p, kind), list)

    return run(page)


_TOKEN = re.compile(r"""//[^\n]*|/\*.*?\*/|"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|`(?:\\.|[^`\\])*`|[\[\]{}]""", re.S)


def js_literal_text(script: str, name: str) -> str | None:
    """Source of the array or object assigned to `name`; brackets in quotes and comments do not count.

    A literal that never closes, or closes crosswise, is none.
    """
    at = re.search(rf"(?<![\w$]){re.escape(name)}\s*[=:]\s*(?=[\[{{])", script)
    if not at:
        return None
    open_: list[str] = []
    for token in _TOKEN.finditer(script, at.end()):
        t = token[0]
        if t in "[{":
            open_.append("]" if t == "[" else "}")
        elif t in "]}":
            if open_.pop() != t:
                return None
            if not open_:
                return script[at.end() : token.end()]
    return None


def js_literal(script: Column | str, name: str) -> Column:
    @F.pandas_udf("string")
    def run(scripts: pd.Series) -> pd.Series:
        return each(scripts, lambda s: js_literal_text(s, name))

    return run(script)


def expand_indexed(payload: list) -> object:
    """Value of an array in which containers hold places in the array instead of values.

    Cycles close on themselves; each place is built once, so shared values stay
    shared. Built with a work list: depth is bounded by memory only.
    """
    is_ref = lambda v: type(v) is int and 0 <= v < len(payload)

    def target(i: int) -> int:
        seen = set()
        while isinstance(payload[i], list) and len(payload[i]) > 1 and payload[i][0] in WRAPPERS and is_ref(payload[i][1]) and i not in seen:
            seen.add(i)
            i = payload[i][1]
        return i

    built: dict[int, object] = {}
    work: list[int] = []

    def value(v: object) -> object:
        if not is_ref(v):
            return v
        i = target(v)
        if i not in built:
            raw = payload[i]
            built[i] = {} if isinstance(raw, dict) else [] if isinstance(raw, list) else raw
            work.append(i)
        return built[i]

    root = value(0) if payload else None
    while work:
        i = work.pop()
        raw, out = payload[i], built[i]
        if isinstance(raw, dict):
            out.update((k, value(v)) for k, v in raw.items())
        elif isinstance(raw, list):
            out.extend(value(v) for v in raw)
    return root


def indexed_json(payload: Column | str) -> Column:
    """The expanded value as JSON; null where the text is no array, or the value has cycles."""

    def one(text: str) -> str | None:
        try:
            raw = json.loads(text)
            return json.dumps(expand_indexed(raw), ensure_ascii=False, sort_keys=True) if isinstance(raw, list) else None
        except (ValueError, RecursionError):
            return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return each(texts, one)

    return run(payload)


def sitemap_urls(xml: Column) -> Column:
    """Distinct addresses of a sitemap in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1)), lambda u: F.regexp_replace(u, "&amp;", "&")))


def written_date(folded: Column, year: Column | None = None) -> Column:
    """Date of "12 mars 2026" in accent-free lower-case text; without a year of its own the given one; null if none is valid."""
    pattern = rf"\b(\d{{1,2}})(?:er)?\s+({'|'.join(MONTHS)})\b(?:\s+(\d{{4}}))?"
    part = lambda i: F.regexp_extract(folded, pattern, i)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(2))
    own = F.when(part(3) != "", part(3)) if year is None else F.when(part(3) != "", part(3)).otherwise(year.cast("string"))
    return F.try_to_date(F.concat(F.coalesce(own, F.lit("x")), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0")))


# Section labels and house wordings of titles, strongest first.
LABEL_TYPES = (
    ("concert_review", ("concert review", "live review")),
    ("interview", ("interview",)),
    ("album_review", ("album review",)),
    ("playlist", ("playlist", "friday's playlist")),
    ("news", ("news", "announcement")),
)
TITLE_STARTS = (("interview", ("interview :", "an interview with ")), ("playlist", ("friday's playlist ", "playlist :")))
NEWS_WORDS = (
    *("announce", "announces", "announced", "to perform", "to release", "unveil", "unveils", "unveiled", "reveal", "reveals", "revealed"),
    *("share new", "shares new", "shared new", "share a new", "shares a new", "shared a new", "share the new", "shares the new", "shared the new"),
    *("new single", "new album", "new video"),
)
ENGLISH_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _plain_title(title: Column) -> Column:
    """Lower case, one kind of dash and apostrophe, a colon apart from the word before it, a space at the end."""
    t = F.translate(F.lower(F.coalesce(title, F.lit(""))), "–’", "-'")
    return F.concat(F.regexp_replace(F.trim(F.regexp_replace(t, r"\s+", " ")), " ?:", " :"), F.lit(" "))


def _dated_place(t: Column) -> Column:
    """Whether a plain title reads "somebody @ somewhere - Month day, year"."""
    date = F.split(F.trim(F.element_at(F.split(t, " - "), -1)), " ")
    day, year = F.regexp_replace(F.get(date, F.lit(1)), "(st|nd|rd|th)?,$", ","), F.get(date, F.lit(2))
    dated = (F.size(date) == 3) & F.get(date, F.lit(0)).isin(*ENGLISH_MONTHS) & day.rlike("^[0-9]{1,2},$") & year.rlike("^20[0-9]{2}$")
    return F.coalesce(dated & F.contains(t, F.lit(" @ ")), F.lit(False))


def article_type(title: Column, labels: Column) -> Column:
    """Type by section labels first, then by the wording of the title; null labels count as none."""
    names = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda v: F.lower(v))
    t = _plain_title(title)
    bare = F.concat(F.lit(" "), F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    has = lambda v: F.array_contains(names, v)
    out = F
    for kind, known in LABEL_TYPES:
        test = F.arrays_overlap(names, F.array(*map(F.lit, known)))
        if kind == "concert_review":
            test |= has("concert") & has("review")
        if kind == "album_review":
            test |= F.startswith(t, F.lit("album review :"))
        out = out.when(test, kind)
    out = out.when(_dated_place(t), "concert_review")
    for kind, phrases in TITLE_STARTS:
        out = out.when(functools.reduce(lambda a, p: a | F.startswith(t, F.lit(p)), phrases, F.lit(False)), kind)
    news = functools.reduce(lambda a, p: a | F.contains(bare, F.lit(f" {p} ")), NEWS_WORDS, F.lit(False))
    return out.when(news, "news").otherwise("other")


def ticket_status(status: Column, sold_out: Column, url: Column) -> Column:
    return F.coalesce(status, F.when(sold_out, "sold_out"), F.when(url.isNotNull(), "tickets"))
