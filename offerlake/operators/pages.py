"""Offers from stored listing pages.

A page is cut at its tags by one regular expression, scripts, styles and comments removed. Tags and texts are read in
document order, page by page in Arrow batches, with a small state: how deep the current item container is, which field is being
read, what has been read. An item ends where its container's tag closes, so nested tags of the same name stay inside. A page without a
closing tag ends its last item with the page.

Selectors are lists of ``(tag, class)``; an empty tag or class fits any. The first element in document order that fits counts.
They are columns, so every store's pages go by that store's selectors in one pass.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake import rules
from offerlake.functions.text import collapse_ws
from offerlake.operators.crawl import host_of, item_policy, whitelist_filter
from offerlake.operators.staging import computed_once

Selector = Sequence[tuple[str, str]]
SELECTOR_TYPE = "array<struct<etiqueta:string,clase:string>>"
_HIDDEN = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
_TAG = re.compile(r"""(</?[a-zA-Z](?:[^<>"']++|"[^"]*+"|'[^']*+')*+>)""")
_NAME = re.compile("<?/?([a-zA-Z][a-zA-Z0-9-]*)")
_CLASS, _HREF = (re.compile(r"\s" + a + r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.ASCII | re.IGNORECASE) for a in ("class", "href"))
_SPACE = re.compile(r"\s+", re.ASCII)
#: Sets of selectors of a batch that are held at once (speed only).
_SELECTORS_KEPT = 100
#: Named entities of item texts (fixed values); ``&amp;`` comes last, so that it opens no other one.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&euro;", "€"), ("&amp;", "&")]
CONTAINER, NAME, PRICE, LINK = "sel_contenedor", "sel_nombre", "sel_precio", "sel_enlace"
OFFER_COLUMNS = ["tienda", "pais", "moneda", "categoria", "keyword_busqueda", "producto", "precio_raw", "url_producto", "fecha_extraccion"]


def parse_selector(css: str) -> list[tuple[str, str]]:
    """``"li.product, .item.new"`` -> ``[("li", "product"), ("", "item.new")]``: alternatives of a tag, classes, or both."""
    out = []
    for part in css.split(","):
        tag, _, cls = part.strip().partition(".")
        if not (tag or cls) or any(c in tag + cls for c in " >+~[]:#"):
            raise ValueError(f"a selector is made of tags and classes: {css!r}")
        out.append((tag.lower(), cls))
    return out


def selector(css: str) -> Column:
    return F.array(*[F.struct(F.lit(t).alias("etiqueta"), F.lit(c).alias("clase")) for t, c in parse_selector(css)])


def unescape(text: Column) -> Column:
    for name, value in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(value))
    return text


def visible(html: Column) -> Column:
    """The page without scripts, styles and comments."""
    return F.regexp_replace(html, _HIDDEN, " ")


class Tags(dict):
    """What is known of a tag as written: its name, whether it closes, which of a list of selectors it fits (a bit for each), its
    link.

    Tags, and names with the same classes, are judged once and looked up from then on; a full table is emptied (speed only).
    """

    KEPT = 20_000

    def __init__(self, selectors: Sequence[Sequence[Mapping[str, str]] | None]):
        super().__init__()
        # an alternative that is null, or has a null part, fits nothing
        self.selectors = [[(s["etiqueta"], set(s["clase"].split(".")) if s["clase"] else set()) for s in choices or () if s and None not in (s.get("etiqueta"), s.get("clase"))]
                          for choices in selectors]
        self.judged: dict[tuple[str, str | None], int] = {}

    def __missing__(self, tag: str) -> tuple[str, bool, int, str | None]:
        name, closes = _NAME.match(tag)[1].lower(), tag[1] == "/"
        fits = 0 if closes else self.fits(tag, name)
        link = _HREF.search(tag) if fits else None
        return self.keep(tag, (name, closes, fits, _bare(link[1]) if link else None))

    def fits(self, tag: str, name: str) -> int:
        written = _CLASS.search(tag)
        key = (name, written[1] if written else None)
        bits = self.judged.get(key)
        if bits is None:
            classes = set(_SPACE.split(_bare(written[1]).strip(" "))) if written else set()
            bits = sum(1 << i for i, choices in enumerate(self.selectors) if any(t in ("", name) and c <= classes for t, c in choices))
            if len(self.judged) >= self.KEPT:
                self.judged.clear()
            self.judged[key] = bits
        return bits

    def keep(self, tag: str, found):
        if len(self) >= self.KEPT:
            self.clear()
        self[tag] = found
        return found


class OpeningTags(Tags):
    """Which selectors an opening tag fits, as ``pattern`` finds it; no text fits none."""

    def pattern(self) -> re.Pattern:
        """The tags that ``_TAG`` finds, without their marks, up to a class that comes first; no text for closing ones, and for a run of
        texts and of tags that have neither attributes nor a name that some selector fits by itself."""
        plain = "|".join(sorted(re.escape(t) for choices in self.selectors for t, c in choices if not c))
        name, rest = "[a-zA-Z][a-zA-Z0-9-]*+", r"""[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+"""
        classed = rf'{name}\s++(?i:class)\s*+=\s*+"[^"]*+"'
        return re.compile(rf"(?:[^<]++|<(?:/|(?!(?i:{plain})>)){name}>)++|<(?:/[a-zA-Z]{rest}>|({classed}|[a-zA-Z]{rest}){rest}>)?", re.ASCII)

    def __missing__(self, tag: str) -> int:
        return self.keep(tag, self.fits(tag, _NAME.match(tag)[1].lower()) if tag else 0)


def _bare(value: str) -> str:
    return value[1:-1] if value[0] in "\"'" else value


def page_items(html: str, tags: Tags) -> Iterator[tuple[str | None, str | None, str | None]]:
    """Name, price text and link of every item of a page; ``tags`` goes by the selectors of container, name, price and link."""
    depth, box = 0, ""  # how deep the item's container is, and its tag; 0: outside
    field, mark, level = None, "", 0  # the field that is being read, its tag and its own nesting
    name = price = link = None
    parts = _TAG.split(html)
    for token, text in zip(parts[1::2], parts[2::2]):
        tag, closes, fits, href = tags[token]
        if depth:
            if tag == box:
                depth += -1 if closes else 1
                if not depth:
                    yield _text(name), _text(price), link
                    field = None
                    continue
            if field is not None and tag == mark:
                level += -1 if closes else 1
                if not level:
                    field = None
            if fits:
                if link is None and fits & 8:
                    link = href
                if field is None:
                    if name is None and fits & 2:
                        field, mark, level = [], tag, 1
                        name = field
                    elif price is None and fits & 4:
                        field, mark, level = [], tag, 1
                        price = field
            if field is not None:
                field.append(text)
        elif fits & 1:
            depth, box, name, price, link = 1, tag, None, None, None
    if depth:
        yield _text(name), _text(price), link


def _text(parts: list[str] | None) -> str | None:
    return None if parts is None else "".join(parts)


def fold_items(html: Column, container: Column, name: Column, price: Column, link: Column) -> Column:
    """Items of a page, ``array<struct<nombre, precio_raw, enlace>>`` in document order; a field that is not there is null."""

    @F.arrow_udf("array<struct<nombre:string,precio_raw:string,enlace:string>>")
    def read(pages: pa.Array, selectors: pa.Array) -> pa.Array:
        known: dict[str, Tags] = {}
        ends, found = [0], []
        for page, css in zip(pages, selectors.to_pylist()):
            if css not in known:
                if len(known) >= _SELECTORS_KEPT:
                    known.clear()
                by = json.loads(css)
                known[css] = Tags([by.get(k) for k in ("c", "n", "p", "l")])
            if page.is_valid:
                found.extend(page_items(page.as_py(), known[css]))
            ends.append(len(found))
        fields = [pa.array([item[i] for item in found], pa.string()) for i in range(3)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["nombre", "precio_raw", "enlace"]))

    selectors = F.to_json(F.struct(container.alias("c"), name.alias("n"), price.alias("p"), link.alias("l")))
    return read(visible(html), selectors)


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` against the page's address: whole, ``//host``, ``/path``, ``?query``, ``#part`` or a name next to the page."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.concat(origin, F.coalesce(F.nullif(F.regexp_extract(F.substr(page, F.length(origin) + 1), r"^(.*/)", 1), F.lit("")), F.lit("/")))
    return (F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]*:)", 1), href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href.startswith("?"), F.concat(page, href))
            .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
            .otherwise(F.concat(folder, href)))


def page_offers(pages: DataFrame, whitelist: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The nine offer columns from stored search pages, with ``pos`` (from 1) and the columns ``keep``.

    ``pages`` has ``tienda, pais, moneda, categoria, keyword_busqueda, url, html, fecha_extraccion`` and the four selector columns.
    An item without a name is dropped, a missing price or link becomes empty text; with ``whitelist`` an item must name a keyword
    of its category. A null page has no items.
    """
    of_page = ["tienda", "pais", "moneda", "categoria", "keyword_busqueda", "fecha_extraccion"]
    items = fold_items(F.col("html"), F.col(CONTAINER), F.col(NAME), F.col(PRICE), F.col(LINK))
    read = pages.select(*of_page, *[c for c in keep if c not in of_page], "url", items.alias("_items")).select("*", F.posexplode("_items").alias("_pos", "_it")).drop("_items")
    # the filters below test the name: it is computed before them, once
    named = computed_once(read, "nombre", F.trim(unescape(collapse_ws(F.col("_it.nombre")))))
    rows = named.select(
        *of_page, *[c for c in keep if c not in of_page], (F.col("_pos") + 1).alias("pos"), "nombre",
        F.trim(unescape(collapse_ws(F.col("_it.precio_raw")))).alias("precio_raw"), resolve_url(F.col("url"), unescape(F.trim("_it.enlace"))).alias("url_producto"))
    rows = item_policy(rows).withColumnRenamed("nombre", "producto")
    if whitelist:
        rows = whitelist_filter(rows)
    return rows.select(*keep, "pos", *[c for c in OFFER_COLUMNS if c not in keep])


def with_selectors(pages: DataFrame, container: str, name: str, price: str, link: str = "a") -> DataFrame:
    """``pages`` with one store's selectors as columns."""
    return pages.withColumns({CONTAINER: selector(container), NAME: selector(name), PRICE: selector(price), LINK: selector(link)})


def selector_probe(pages: DataFrame, containers: Sequence[str] = rules.PROBE_CONTAINERS, names: Sequence[str] = rules.PROBE_NAME_SELECTORS,
                   prices: Sequence[str] = rules.PROBE_PRICE_SELECTORS) -> DataFrame:
    """Per site and kind (``contenedor, nombre, precio``): which candidate fits first on how many pages (none: ''). A container
    must repeat.

    Candidates that look into another element (``.price bdi``) are judged by the last one. A page is read once for all candidates.
    """
    kinds = {"contenedor": (containers, 2), "nombre": (names, 1), "precio": (prices, 1)}
    candidates = [(kind, css, least) for kind, (choices, least) in kinds.items() for css in choices]
    selectors = [[{"etiqueta": t, "clase": c} for t, c in parse_selector(css.split()[-1])] for _, css, _ in candidates]

    def first(once: int, again: int) -> list[str | None]:
        hits = [(kind, css) for i, (kind, css, least) in enumerate(candidates) if (once if least == 1 else again) >> i & 1]
        return [next((css for kind, css in hits if kind == k), None) for k in kinds]

    @F.arrow_udf("struct<contenedor:string,nombre:string,precio:string>")
    def probe(html: pa.Array) -> pa.Array:
        tags, known, places = OpeningTags(selectors), {}, []
        find, look = tags.pattern().findall, tags.__getitem__
        for page in html:
            # candidates that fit a tag, and those that fit two; a null page has no tags
            once = again = 0
            for fits in map(look, find(page.as_py() or "")):
                if fits:
                    again |= once & fits
                    once |= fits
            places.append(known.setdefault((once, again), len(known)))
        found = [first(*bits) for bits in known]
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in range(len(kinds))], list(kinds)).take(pa.array(places, pa.int32()))

    found = pages.select(host_of(F.col("url")).alias("sitio"), probe(visible(F.col("html"))).alias("_f")).select("sitio", "_f.*")
    # pages with the same answers are counted before the answers become rows
    same = found.groupBy("sitio", *kinds).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(k).alias("tipo"), F.col(k).alias("selector")) for k in kinds])
    per = same.select("sitio", "_n", F.inline(pairs)).groupBy("sitio", "tipo", "selector").agg(F.sum("_n").alias("paginas"))
    return per.select("sitio", "tipo", F.coalesce("selector", F.lit("")).alias("selector"), "paginas")


# the reader goes to the tasks with the plan, so that it runs where this package is not installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
