"""Site scans by declaration: where a site's cards stand in its pages, and where in a card each field stands.

A site is data; one scanner reads all of them on Arrow batches of landed pages,
and built-in functions turn the fields into listings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import fold_latin, normal_time
from ..functions.payloads import written_date

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_COMPOUND = re.compile(r"([#.]?)([\w-]+)|\[([\w-]+)(?:(\^?=)['\"]?([^'\"\]]*)['\"]?)?\]")


@dataclass(frozen=True)
class Site:
    """`card` and the values of `fields` are selectors: tag, #id, .class, [attribute], [attribute=value] or [attribute^=value], spaces for "inside".

    A field ends in @name for an attribute instead of the text; without a
    selector before it that of the card itself. After ^ a selector means the
    last such text before the card, as of a day that several cards stand under. A field's first element counts,
    for `performers` each line of it. Fields that `listings` reads: title, date,
    time, place, city, category, ticket, image, status, performers.
    """

    card: str
    fields: dict[str, str]
    base: str
    venue: str | None = None
    city: str | None = None
    categories: tuple[str, ...] = ()


#: Where sites that give their whole programme on one page keep it.
SITES = {
    "Le Trabendo": Site("a.event", {"title": ".name-event", "date": ".date-event", "category": ".pastille", "ticket": "@href", "image": "picture img@src"}, "https://www.letrabendo.net/programmation/", "Le Trabendo", "Paris", ("concert",)),
    "Cabaret Sauvage": Site(".post-item-3.w-dyn-item", {"title": ".work-title", "date": ".post-date", "category": ".category-link", "ticket": "a[href^=/work/]@href", "image": "img.image-hover@src", "status": ".work-title"}, "https://www.cabaretsauvage.com/agenda", "Cabaret Sauvage", "Paris", ("concert",)),
    "Casino de Paris": Site("li.cards-grid__item .card", {"title": "h3.title", "date": ".date", "time": ".date", "category": ".event-title", "ticket": "a.js-main-link@href", "image": ".image img@src", "status": ".actions"}, "https://www.casinodeparis.fr/fr", "Casino de Paris", "Paris", ("concert",)),
    "U-Turn Touring": Site(".show-full-row", {"title": ".show-full-name", "date": ".show-full-date", "place": ".show-full-venue", "ticket": "a.ticket-btn@href", "performers": ".show-full-name"}, "https://www.uturntouring.com/shows/"),
    "Nouveau Casino": Site("li.event_item[data-type=concert]", {"title": ".event_header h3", "performers": ".event_header h3", "date": "^li.day_item time .date", "time": ".event_header p span", "ticket": ".event_tickets a@href", "image": "picture img@src", "status": ".event_header h3"}, "https://www.nouveaucasino.fr/", "Nouveau Casino", "Paris"),
}


@dataclass(frozen=True)
class Element:
    tag: str
    attrs: dict[str, str] = field(hash=False)

    def fits(self, compound: str) -> bool:
        for sign, name, attr, op, value in _COMPOUND.findall(compound):
            have = self.attrs.get(attr or {"#": "id", ".": "class"}.get(sign, ""))
            if attr:
                ok = have is not None and (not op or (have.startswith(value) if op == "^=" else have == value))
            else:
                ok = self.tag == name if not sign else have == name if sign == "#" else name in (have or "").split()
            if not ok:
                return False
        return True


def fits(stack: list[Element], selector: str) -> bool:
    """Whether the last element stands where the selector says; earlier parts stand further out, in order."""
    *outer, last = selector.split()
    if not stack or not stack[-1].fits(last):
        return False
    at = len(stack) - 2
    for part in reversed(outer):
        while at >= 0 and not stack[at].fits(part):
            at -= 1
        if at < 0:
            return False
        at -= 1
    return True


class _Scanner(HTMLParser):
    def __init__(self, site: Site):
        super().__init__(convert_charrefs=True)
        self.site, self.stack, self.cards, self.open = site, [], [], None
        self.fields = {k: v.partition("@")[::2] for k, v in site.fields.items()}
        self.taking: dict[str, int] = {}
        self.above, self.heading = {}, {}  # texts outside cards, and those being read

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.handle_data("\n")
        self.stack.append(Element(tag, {k: v or "" for k, v in attrs}))
        if self.open is None and fits(self.stack, self.site.card):
            self.open = len(self.stack)
            self.cards.append({**self.above})
            for name, (selector, attr) in self.fields.items():
                if not selector and attr in self.stack[-1].attrs:
                    self.cards[-1][name] = self.stack[-1].attrs[attr]
        elif self.open is None:
            for name, (selector, _) in self.fields.items():
                if selector.startswith("^") and fits(self.stack, selector[1:]):
                    self.above[name], self.heading[name] = "", len(self.stack)
        else:
            for name, (selector, attr) in self.fields.items():
                if selector and selector[0] != "^" and name not in self.cards[-1] and fits(self.stack[self.open - 1 :], selector):
                    if attr:
                        if attr in self.stack[-1].attrs:
                            self.cards[-1][name] = self.stack[-1].attrs[attr]
                    else:
                        self.cards[-1][name] = ""
                        self.taking[name] = len(self.stack)
        if tag in VOID:
            self.close_to(len(self.stack) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.close_to(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                self.close_to(at)
                return

    def close_to(self, depth: int) -> None:
        del self.stack[depth:]
        self.taking = {k: d for k, d in self.taking.items() if d <= depth}
        self.heading = {k: d for k, d in self.heading.items() if d <= depth}
        if self.open is not None and depth < self.open:
            self.open, self.taking = None, {}

    def handle_data(self, data: str) -> None:
        for name in self.heading:
            self.above[name] += data
        for name in self.taking:
            self.cards[-1][name] += data if data == "\n" else data.replace("\n", " ") + " " * (not data.endswith(" "))


def page_cards(page: str, site: Site) -> list[dict[str, str]]:
    """Fields of every card of a page, in its order; lines of a text are parted by line feeds, other white space collapses."""
    scanner = _Scanner(site)
    scanner.feed(page)
    scanner.close()
    tidy = lambda text: "\n".join(x for line in text.split("\n") if (x := " ".join(line.split())))
    return [{k: tidy(v) for k, v in card.items()} for card in scanner.cards]


def cards(pages: DataFrame, sites: dict[str, Site] = SITES) -> DataFrame:
    """(source, page, card, fields) of pages(source, page, html); sources that are not declared and null pages have none."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(s, p, i, list(c.items())) for s, p, h in zip(*(b.column(c).to_pylist() for c in ("source", "page", "html")), strict=True) if h and s in sites for i, c in enumerate(page_cards(h, sites[s]))]
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.map_(pa.string(), pa.string()))], ["source", "page", "card", "fields"])

    told = pages.select("source", F.col("page").cast("string").alias("page"), "html")
    return told.mapInArrow(rows, "source string, page string, card int, fields map<string,string>")


def card_date(text: Column, year: Column | None = None) -> Column:
    """The day in a card's text: written out in French, or as 31.12.26, 31/12/2026, 2026-12-31; without a year the given one."""
    folded = F.regexp_replace(fold_latin(text), r"\s+[–—―-]\s*", " ")
    iso = F.regexp_extract(folded, r"(?<!\d)(20\d{2}-\d{2}-\d{2})(?!\d)", 1)
    part = lambda i: F.regexp_extract(folded, r"\b(\d{1,2})[./](\d{1,2})(?:[./](\d{2,4}))?\b", i)
    own = F.when(F.length(part(3)) == 2, F.concat(F.lit("20"), part(3))).when(F.length(part(3)) == 4, part(3))
    own = own if year is None else F.coalesce(own, year.cast("string"))
    numeric = F.try_to_date(F.concat(F.coalesce(own, F.lit("x")), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0")))
    return F.coalesce(F.try_to_date(F.nullif(iso, F.lit(""))), written_date(folded, year), numeric)


def absolute(url: Column, base: Column) -> Column:
    """A link of a page as a whole address."""
    origin = F.regexp_extract(base, "^https?://[^/]+", 0)
    folder = F.regexp_replace(base, "[^/]*$", "")
    return F.when(url.rlike("^https?://"), url).when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url)).when(F.startswith(url, F.lit("/")), F.concat(origin, url)).when(url != "", F.concat(folder, url))


#: Words of a card that tell how its tickets stand, strongest first.
STATES = (("cancelled", ("annule", "annulee", "cancelled", "canceled")), ("postponed", ("reporte", "reportee", "postponed")), ("sold_out", ("complet", "sold out")))


def listings(found: DataFrame, sites: dict[str, Site] = SITES, year: Column | None = None) -> DataFrame:
    """Listings of cards: (source, page, card, day, time, headliner, performers, venue, city, category, ticket_url, ticket_status, image_url).

    year: of days told without one. Cards without a title or a valid day are left out, as are those of another
    category than the site's. A place reads "city — venue" or "city, venue" where
    a site has no venue of its own. Words of STATES in the status, or in brackets or behind a
    dash at the end of the title, give the ticket's state.
    """
    told = [(name, s.base, s.venue, s.city, list(s.categories)) for name, s in sites.items()]
    about = found.sparkSession.createDataFrame(told, "source string, _base string, _venue string, _city string, _categories array<string>")  # a row a site
    f = lambda name: F.nullif(F.trim(F.replace(F.col("fields")[name], F.lit("\n"), F.lit(" "))), F.lit(""))
    words = "|".join(w for _, ws in STATES for w in ws)
    states = fold_latin(F.concat_ws(" ", f("status"), f("title")))
    state = F
    for name, ws in STATES:
        state = state.when(states.rlike(rf"(?<!\w)(?:{'|'.join(ws)})(?!\w)"), name)
    bare = F.trim(F.regexp_replace(f("title"), rf"(?i)\s*\[(?:{words}|reporté|reportée|annulé|annulée)\]|\s+[–-]\s*(?:{words})\s*$", ""))
    place = F.split(f("place"), r"\s*,?\s+—\s+|\s*,\s*", 2)
    told_city = F.size(place) > 1
    rows = found.join(F.broadcast(about), "source").select(
        "source", "page", "card", card_date(f("date"), year).alias("day"),
        normal_time(F.nullif(F.regexp_extract(f("time"), r"(?i)\b(\d{1,2}\s*[:h]\s*(?:\d{2})?)(?!\d)", 1), F.lit(""))).alias("time"),
        bare.alias("headliner"), F.filter(F.split(F.col("fields")["performers"], "\n"), lambda x: F.trim(x) != "").alias("performers"),
        F.coalesce("_venue", F.element_at(place, -1)).alias("venue"), F.coalesce("_city", f("city"), F.when(told_city, F.get(place, F.lit(0)))).alias("city"),
        f("category").alias("category"), absolute(f("ticket"), F.col("_base")).alias("ticket_url"), state.when(f("ticket").isNotNull(), "tickets").alias("ticket_status"), absolute(f("image"), F.col("_base")).alias("image_url"), "_categories",
    )
    fits_ = (F.size("_categories") == 0) | F.array_contains("_categories", fold_latin(F.col("category")))
    return rows.where((F.coalesce("headliner", F.lit("")) != "") & F.col("day").isNotNull() & F.coalesce(fits_, F.lit(False))).drop("_categories")
