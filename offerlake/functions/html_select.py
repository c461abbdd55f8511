"""Small CSS-like selection over HTML text, used per page inside ``mapInPandas`` (Spark has no HTML parser).

Supported selectors: comma-separated alternatives; each a descendant chain of simple selectors ``tag``, ``.class``,
``tag.class.other``. That covers the store configurations (``li.product``, ``h3.wd-entities-title``, ``span.price``,
``.price ins .amount``, ``h2 a``). Text is the trimmed concatenation of descendant text (like ``innerText.trim()``);
links are the ``href`` attribute, optionally resolved against the page URL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIP_TEXT = {"script", "style"}


@dataclass
class Node:
    tag: str
    attrs: dict
    children: list = field(default_factory=list)
    text: list = field(default_factory=list)   # interleaved str and Node, in document order

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def inner_text(self) -> str:
        if self.tag in SKIP_TEXT:
            return ""
        return "".join(p if isinstance(p, str) else p.inner_text() for p in self.text)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v or "") for k, v in attrs})
        parent = self.stack[-1]
        parent.children.append(node)
        parent.text.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):   # close up to the matching open tag (lenient)
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].text.append(data)


def parse(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


def _simple(sel: str) -> tuple[str | None, set[str]]:
    parts = sel.split(".")
    return (parts[0] or None), {p for p in parts[1:] if p}


def _matches(node: Node, simple: tuple[str | None, set[str]]) -> bool:
    tag, classes = simple
    return (tag is None or node.tag == tag) and classes <= node.classes


def _descendants(node: Node):
    for c in node.children:
        yield c
        yield from _descendants(c)


def _select_chain(node: Node, chain: list[tuple[str | None, set[str]]]) -> list[Node]:
    current = [node]
    for simple in chain:
        nxt, seen = [], set()
        for n in current:
            for d in _descendants(n):
                if id(d) not in seen and _matches(d, simple):
                    seen.add(id(d))
                    nxt.append(d)
        current = nxt
    return current


def select(node: Node, selector: str) -> list[Node]:
    """All matches of any alternative, in document order (like ``querySelectorAll``)."""
    hits = {}
    for alt in selector.split(","):
        chain = [_simple(s) for s in alt.split()]
        for n in _select_chain(node, chain):
            hits[id(n)] = n
    order = {id(n): i for i, n in enumerate(_descendants(node))}
    return sorted(hits.values(), key=lambda n: order[id(n)])


def select_first(node: Node, selector: str) -> Node | None:
    found = select(node, selector)
    return found[0] if found else None


def extract_items(html: str, page_url: str, container: str, sel_name: str, sel_price: str, sel_url: str,
                  resolve: bool = True) -> list[tuple[int, str | None, str | None, str | None]]:
    """``(pos, name, price, url)`` per container: name/price = trimmed text of the first match (None if absent),
    url = ``href`` of the first match (None if absent)."""
    root = parse(html)
    out = []
    for pos, item in enumerate(select(root, container), start=1):
        name = select_first(item, sel_name)
        price = select_first(item, sel_price)
        link = select_first(item, sel_url)
        href = None
        if link is not None and "href" in link.attrs:
            href = urljoin(page_url or "", link.attrs["href"]) if resolve else link.attrs["href"]
        out.append((pos, name.inner_text().strip() if name else None, price.inner_text().strip() if price else None, href))
    return out


def probe(html: str, containers: list[str], name_selectors: list[str], price_selectors: list[str],
          sample: int = 3) -> tuple[str | None, int, str | None, str | None, int]:
    """Selector probe of one page: the first container selector matching at least two elements, its item count, the
    first name and price selectors that give non-empty text on the sampled items, and how many sampled items have a
    name. ``(container, items, name_selector, price_selector, named)``."""
    root = parse(html)
    chosen, items = None, []
    for c in containers:
        items = select(root, c)
        if len(items) >= 2:
            chosen = c
            break
    if chosen is None:
        return None, len(items), None, None, 0
    name_hit = price_hit = None
    named = 0
    for item in items[:sample]:
        n_sel = next((s for s in name_selectors if (e := select_first(item, s)) and e.inner_text().strip()), None)
        p_sel = next((s for s in price_selectors if (e := select_first(item, s)) and e.inner_text().strip()), None)
        named += n_sel is not None
        name_hit = name_hit or n_sel
        price_hit = price_hit or p_sel
    return chosen, len(items), name_hit, price_hit, named
