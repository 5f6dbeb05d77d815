"""Pages of a made-up museum directory, in markup of its own.

Only class names, item properties and the path of a person's page are what the selectors look for.
"""

from html import escape

BASE = "https://site.test/Search/Type,Biography/Initial,A/"


def element(name, content="", **attributes):
    given = "".join(f" {k.rstrip('_')}='{v}'" for k, v in attributes.items() if v is not None)
    return f"<{name}{given}>{content}</{name}>"


def card(url, name, dates="1900-1980", activities=("test",)):
    """A person in a listing, as an article with a definition-like body."""
    tags = element("ul", "".join(element("li", element("a", a, href=f"#{n}")) for n, a in enumerate(activities)), class_="activity")
    person = element("h3", element("a", name, href=escape(url)), class_="name") + element("em", dates, class_="dates")
    return element("article", person + tags, class_="wide personItem")


def listing(labels, cards):
    """``labels``: (text, id or None); an entry without id is the current page."""
    entries = [element("li", element("a", text, id=name) if name else element("span", text)) for text, name in labels]
    return element("main", "".join(cards) + element("footer", element("ol", "".join(entries)), class_="pages"))


def detail(given, family, born, died, tags, text):
    """A person's own page: life dates in a table, tags in a list, the text last."""
    name = element("h2", element("b", given, itemprop="givenName") + " " + element("b", family, itemprop="familyName"))
    dates = element("table", element("tr", element("td", born, class_="birthDateText") + element("td", died, class_="deathDateText")))
    links = element("p", ", ".join(element("a", t, href="/Search/Type,Biography/Tag,9/") for t in tags), class_="black-bg")
    return name + dates + element("section", links, class_="personalDataControl") + element("div", text, itemprop="description")


def pages(spark, rows):
    """Rows of (url, html[, status]) in capture order."""
    full = [(u, h, s[0] if s else 200, n) for n, (u, h, *s) in enumerate(rows)]
    return spark.createDataFrame(full, "url string, html string, status int, page_seq long")
