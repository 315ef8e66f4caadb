"""Site scans by declaration, each site with a page of its shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.sources import sites

PAGES = {
    "Le Trabendo": """<main><a class="event big" href="/ana"><span class="pastille concert">Concert</span><picture><img src="/i/a.jpg"></picture><p class="date-event">Samedi 14 ― novembre 2026</p><h2 class="name-event">Ana &amp; <b>Bob</b></h2></a>
<a class="event" href="/x"><span class="pastille club">Club</span><p class="date-event">15 novembre 2026</p><h2 class="name-event">Nuit</h2></a></main>""",
    "Cabaret Sauvage": """<div class="w-dyn-item post-item-3"><div class="category-link">Concert</div><div class="post-date">Sam 05.12.26</div><h3 class="work-title">Cy - COMPLET</h3><a href="/other">x</a><a href="/work/cy">voir</a><img class="image-hover" src="//cdn.org/c.jpg"></div>""",
    "Casino de Paris": """<ul><li class="cards-grid__item"><div class="card"><div class="event-title">Concert</div><div class="image"><img src="d.jpg"></div><h3 class="title">Dee</h3><div class="date">Le 3 mars 2027 à 20h30</div><a class="js-main-link" href="https://t.org/dee">+</a><div class="actions">Annulé</div></div></li>
<li class="cards-grid__item"><div class="card"><div class="event-title">Concert</div><h3 class="title"></h3><div class="date">4 mars 2027</div></div></li></ul>""",
    "U-Turn Touring": """<div class="show-full-row"><div class="show-full-date">12/02/2027</div><div class="show-full-name">Eve</div><div class="show-full-venue">Paris, — La Salle, Haut</div><a class="ticket-btn" href="https://t.org/e">b</a></div><div class="show-full-row"><div class="show-full-name">no day</div></div>""",
    "Nouveau Casino": """<ul><li class="day_item"><time>Sam <span class="date">30.01</span></time></li><li class="day_item"><time><span class="date">31.01</span></time><ul><li class="event_item" data-type="concert"><div class="event_header"><h3>Fay [SOLD OUT]<br>Gus</h3><p><span>19:30</span></p></div><div class="event_tickets"><a href="/t/f">t</a></div></li><li class="event_item" data-type="club"><h3>no</h3></li></ul></li></ul>""",
}


def test_each_site_gives_its_listings(spark):
    pages = spark.createDataFrame([(s, f"p{i}", h) for i, (s, h) in enumerate(PAGES.items())] + [("unknown", "q", "<a class=event>"), ("Le Trabendo", "r", None), ("Le Trabendo", "s", "")], "source string, page string, html string")
    got = {r["source"]: r.asDict() for r in sites.listings(sites.cards(pages), year=F.lit(2027)).collect()}
    pick = lambda s, *c: tuple(got[s][x] for x in c)
    assert set(got) == set(PAGES)
    assert pick("Le Trabendo", "day", "headliner", "ticket_url", "ticket_status", "image_url", "venue", "city") == (dt.date(2026, 11, 14), "Ana & Bob", "https://www.letrabendo.net/ana", "tickets", "https://www.letrabendo.net/i/a.jpg", "Le Trabendo", "Paris")
    assert pick("Cabaret Sauvage", "day", "headliner", "ticket_url", "ticket_status", "image_url") == (dt.date(2026, 12, 5), "Cy", "https://www.cabaretsauvage.com/work/cy", "sold_out", "https://cdn.org/c.jpg")
    assert pick("Casino de Paris", "day", "time", "headliner", "ticket_status", "image_url") == (dt.date(2027, 3, 3), "20:30", "Dee", "cancelled", "https://www.casinodeparis.fr/d.jpg")
    assert pick("U-Turn Touring", "day", "headliner", "performers", "city", "venue", "image_url") == (dt.date(2027, 2, 12), "Eve", ["Eve"], "Paris", "La Salle, Haut", None)
    assert pick("Nouveau Casino", "day", "time", "headliner", "performers", "ticket_status", "ticket_url") == (dt.date(2027, 1, 31), "19:30", "Fay Gus", ["Fay [SOLD OUT]", "Gus"], "sold_out", "https://www.nouveaucasino.fr/t/f")


@pytest.mark.parametrize(("html", "want"), [
    ("<div class=c><p class=t>a<p class=t>b</div>", [{"t": "a b"}]),
    ("<div class=c><i class=t>a</i></div><div class=c><i class=t>b", [{"t": "a"}, {"t": "b"}]),
    ("<div class=c><div class=c><i class=t>a</i></div></div>", [{"t": "a"}]),
    ("<i class=t>out</i><div class='x c'></div>", [{}]),
    ("</div><div class=c><br/><img class=t></div>", [{"t": ""}]),
    ("", []),
])
def test_cards_of_odd_pages(html, want):
    assert sites.page_cards(html, sites.Site("div.c", {"t": ".t"}, "https://x.org/")) == want


def test_selectors():
    e = sites.Element
    stack = [e("main", {"id": "m"}), e("ul", {"class": "a b"}), e("li", {}), e("a", {"href": "/work/1", "data-x": ""})]
    for selector, ok in (("a", True), ("#m a", True), ("main .b a[href]", True), ("ul main a", False), ("a[href^=/work/]", True), ("a[href=/work/]", False), ("a[data-x]", True), (".a.b li a", True), (".a.c a", False), ("li", False)):
        assert sites.fits(stack, selector) is ok, selector


def test_card_dates(spark):
    one = lambda t, y=None: spark.range(1).select(sites.card_date(F.lit(t), None if y is None else F.lit(y))).first()[0]
    assert [one(t) for t in ("le 1er août 2026", "1.2.26", "01/02/2026", "2026-02-03T20:00", "31.02.2026", "x", "5 mai", "5.6")] == [dt.date(2026, 8, 1), dt.date(2026, 2, 1), dt.date(2026, 2, 1), dt.date(2026, 2, 3), None, None, None, None]
    assert one("5 mai", 2027) == dt.date(2027, 5, 5) and one("5.6", 2027) == dt.date(2027, 6, 5) and one("x", 2027) is None and one(None, 2027) is None
