"""HTML pages as rows, on the standard library's tolerant parser: one page in, many rows out."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that end an open one of the same group, as browsers do.
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
SCOPES = {"table", "ul", "ol", "select", "section", "div", "main", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
UNSEEN = {"script", "style", "nav", "form", "noscript", "template", "header", "footer"}
NO_PAGE = ("#", "javascript:", "mailto:", "tel:")


class Node:
    """An element with its attributes, its children (nodes and texts) and its parent."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """All elements below this one, in document order; without recursion, so depth is no limit."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, seen_only: bool = False) -> str:
        parts, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x)
            elif not seen_only or x is self or not x.hidden():
                if x.tag in ("br", "p", "div", "li", "td", "th", "tr"):
                    parts.append(" ")
                stack += reversed(x.children)
        return tidy("".join(parts))

    def within(self, tags: set[str]) -> bool:
        p = self.parent
        while p is not None:
            if p.tag in tags:
                return True
            p = p.parent
        return False

    def hidden(self) -> bool:
        return self.tag in UNSEEN or "hidden" in self.attrs or bool(re.search(r"display\s*:\s*none", self.attrs.get("style", ""), re.I))


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends, node = CLOSES.get(tag), self.at
        while ends and node.parent is not None and node.tag not in SCOPES:
            if node.tag in ends:
                self.at = node.parent
                if tag != "tr":
                    break
            node = node.parent
        child = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(child)
        if tag not in VOID:
            self.at = child

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent or self.root

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tidy(text: str) -> str:
    return " ".join(re.sub("[​‌‍﻿™®]", "", text).split())


def parse(body: str | bytes | None) -> Node:
    """The tree of a page: UTF-8 (damage replaced), without an XML prolog. NULL gives an empty tree."""
    text = body.decode("utf-8", "replace") if isinstance(body, bytes | bytearray) else body or ""
    tree = _Tree()
    tree.feed(re.sub(r"\A\s*<\?xml[^>]*\?>", "", text))
    tree.close()
    return tree.root


def _first(nodes: Iterator[Node], *tags: str) -> Node | None:
    return next((n for n in nodes if n.tag in tags), None)


def index_entries(body: str | bytes | None, base: str, wanted: str) -> list[tuple[str, str, str]]:
    """heading, label, url of the entries an index page lists by section; each address once, the first one wins."""
    found: dict[str, tuple[str, str, str]] = {}
    for section in (n for n in parse(body).walk() if n.tag == "section"):
        heading = next((t for n in section.walk() if n.tag in ("h2", "h3", "h4") and (t := n.text())), "")
        for a in (n for n in section.walk() if n.tag == "a" and n.attrs.get("href")):
            url, label = urljoin(base, a.attrs["href"].strip()), a.text()
            if label and re.search(wanted, url) and url.rstrip("/") != base.rstrip("/"):
                found.setdefault(url, (heading, label, url))
    return list(found.values())


def docs_page(body: str | bytes | None, url: str, wanted: str, site_suffix: str = "", doc_like: str = r"\.(pdf|zip|xlsx?)(\?|$)") -> dict:
    """title, options, selected, items and health of one documentation page.

    options: label and address of the first menu that leads to documentation pages; selected: the label of this page's
    own address; items: links in list entries that hold a heading, with their date text; missed: document-like links
    outside header, footer and navigation that are no items.
    """
    tree = parse(body)
    title = _first(tree.walk(), "title")
    name = title.text() if title else ""
    name = name.removesuffix(site_suffix).strip() if site_suffix else name
    options: list[dict] = []
    menus = 0
    for select in (n for n in tree.walk() if n.tag == "select"):
        held = [n for n in select.walk() if n.tag == "option"]
        menus += len(held) > 1
        links = [{"label": re.sub("^Version ", "", o.text()), "url": urljoin(url, o.attrs["value"].strip())} for o in held if o.attrs.get("value") and re.search(wanted, urljoin(url, o.attrs["value"]))]
        options = options or links
    own = url.rstrip("/")
    selected = next((o["label"] for o in options if o["url"].rstrip("/") == own), "")
    items = []
    for a in (n for n in tree.walk() if n.tag == "a" and n.attrs.get("href") and n.within({"li"})):
        heading = _first(a.walk(), *HEADINGS)
        if heading is not None:
            rest = a.text().removeprefix(heading.text()).strip()
            items.append({"title": heading.text(), "date": rest, "url": urljoin(url, a.attrs["href"].strip())})
    got = {i["url"] for i in items}
    links = {urljoin(url, n.attrs["href"].strip()) for n in tree.walk() if n.tag == "a" and n.attrs.get("href") and re.search(doc_like, n.attrs["href"], re.I) and not n.within({"header", "footer", "nav"})}
    signals = []
    nodes = list(tree.walk())
    if any(n.tag == "iframe" and n.attrs.get("src") for n in nodes):
        signals.append("iframe")
    if any(n.attrs.get("role") in ("tab", "tablist") for n in nodes):
        signals.append("tabs")
    if any(n.tag in ("button", "a") and re.search(r"(load|show|view) (more|all)", n.text(), re.I) for n in nodes):
        signals.append("load-more")
    if any(n.tag != "img" and ({"data-ajax", "data-url", "data-src"} & n.attrs.keys()) for n in nodes):
        signals.append("data-url")
    return {"title": name, "options": options, "selected": selected, "items": items, "missed": sorted(links - got), "selects": menus, "signals": signals}


def content_links(body: str | bytes | None, base: str) -> list[tuple[int, str, str, str]]:
    """pos, label, href, heading for each link in a page's main content, with the nearest heading before it.

    A link without text takes its title or aria-label.
    """
    tree = parse(body)
    main = _first(tree.walk(), "main") or _first(tree.walk(), "body") or tree
    out, heading = [], ""
    for n in main.walk():
        if n.tag in HEADINGS:
            heading = n.text() or heading
        elif n.tag == "a" and (href := n.attrs.get("href", "").strip()) and not href.lower().startswith(NO_PAGE) and not n.within({"header", "footer", "nav"}):
            label = n.text() or tidy(n.attrs.get("title", "")) or tidy(n.attrs.get("aria-label", ""))
            out.append((len(out), label, urljoin(base, href), heading))
    return out


def table_cells(table: Node, base: str) -> tuple[list[str], list[list[str]], list[str]]:
    """header, rows and the links of each row. The header is the thead's cells, or a first row of th only."""
    own = lambda n: (lambda p: p is table)(_nearest(n, "table"))
    head = next((n for n in table.walk() if n.tag == "thead" and own(n)), None)
    header = [n.text(True) for n in head.walk() if n.tag in ("th", "td") and not n.hidden()] if head else []
    rows, links = [], []
    for tr in (n for n in table.walk() if n.tag == "tr" and own(n) and not (head is not None and n.within({"thead"}))):
        cells = [c for c in tr.walk() if c.tag in ("td", "th") and own(c) and not c.hidden()]
        if not cells:
            continue
        if not header and not rows and all(c.tag == "th" for c in cells):
            header = [c.text(True) for c in cells]
            continue
        rows.append([c.text(True) for c in cells])
        links.append(" ".join(urljoin(base, a.attrs["href"].strip()) for a in tr.walk() if a.tag == "a" and a.attrs.get("href")))
    return header, rows, links


def _nearest(node: Node, tag: str) -> Node | None:
    p = node.parent
    while p is not None and p.tag != tag:
        p = p.parent
    return p


def snapshot_page(body: str | bytes | None, base: str, shown_rows: int = 300) -> dict:
    """title, Markdown and tables of a page kept as a snapshot. Hidden parts, scripts, navigation and forms are left out.

    A table's caption is its own, else that of the tab its panel belongs to, else the heading before it. The Markdown
    shows each text once and at most shown_rows rows of a table; the tables themselves are whole.
    """
    tree = parse(body)
    main = _first(tree.walk(), "main") or _first(tree.walk(), "body") or tree
    title = _first(tree.walk(), "title")
    name = re.split(r"\s+[|]\s+", title.text())[0] if title else ""
    by_id = {n.attrs["id"]: n for n in tree.walk() if n.attrs.get("id")}
    lines, tables, said, heading = [], [], set(), ""
    stack: list[Node | str] = list(reversed(main.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if (t := tidy(x)) and t not in said:
                said.add(t)
                lines.append(t)
            continue
        if x.hidden() or x.attrs.get("role") in ("tab", "tablist"):
            continue
        if x.tag in HEADINGS:
            heading = x.text(True) or heading
            lines.append("#" * int(x.tag[1]) + " " + heading)
        elif x.tag == "table":
            caption = _first(x.walk(), "caption")
            panel = x
            while panel is not None and not panel.attrs.get("aria-labelledby"):
                panel = panel.parent
            label = by_id.get(panel.attrs["aria-labelledby"]) if panel is not None else None
            header, rows, links = table_cells(x, base)
            header = [h or f"col {i}" for i, h in enumerate(header, 1)]
            tables.append({"caption": (caption.text(True) if caption else "") or (label.text() if label else "") or heading, "header": header, "rows": rows, "links": links})
            bar = lambda cells: "| " + " | ".join(c.replace("|", "\\|") for c in cells) + " |"
            lines += [bar(header), "|" + "---|" * max(1, len(header)), *map(bar, rows[:shown_rows])]
            if len(rows) > shown_rows:
                lines.append(f"{len(rows)} rows in all")
        elif x.tag in ("p", "li") and not any(n.tag in ("table", *HEADINGS) for n in x.walk()):
            if (t := x.text(True)) and t not in said:
                said.add(t)
                lines.append(("* " if x.tag == "li" else "") + t)
        else:
            stack += reversed(x.children)
    return {"title": name, "md": "\n\n".join(lines), "tables": tables}


def archive_pages(body: str | bytes | None, base: str, wanted: str) -> list[str]:
    """Addresses of the archive pages a page's menus lead to, each once."""
    values = (urljoin(base, n.attrs["value"].strip()) for n in parse(body).walk() if n.tag == "option" and n.attrs.get("value"))
    return list(dict.fromkeys(v for v in values if re.search(wanted, v)))


def _udf(pages: DataFrame, schema: str, rows_of, url: str, body: str) -> DataFrame:  # noqa: ANN001
    """A page table through a parser: page, then the parser's columns. Batches are Arrow; a page that fails gives no rows."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, *r) for u, b in zip(batch["u"], batch["b"]) if b is not None for r in rows_of(b, u or "")]
            yield pd.DataFrame(rows, columns=["page", *names])

    return pages.select(F.col(url).alias("u"), F.col(body).alias("b")).mapInPandas(run, f"page string, {schema}")


def read_links(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """page, pos, label, href, heading."""
    return _udf(pages, "pos int, label string, href string, heading string", content_links, url, body)


def read_index(pages: DataFrame, wanted: str, url: str = "url", body: str = "body") -> DataFrame:
    """page, pos, heading, label, url."""
    return _udf(pages, "pos int, heading string, label string, url string", lambda b, u: ((i, *e) for i, e in enumerate(index_entries(b, u, wanted), 1)), url, body)


def read_archive(pages: DataFrame, wanted: str, url: str = "url", body: str = "body") -> DataFrame:
    """page, url: the archive pages each page's menus lead to."""
    return _udf(pages, "url string", lambda b, u: [(v,) for v in archive_pages(b, u, wanted)], url, body)


def read_tables(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """Long form of all tables: page, table_no, caption, row_no, col_no, header, value; a last column holds the row's links."""

    def cells(b: str, u: str) -> Iterator[tuple]:
        for t, table in enumerate(snapshot_page(b, u)["tables"]):
            for r, (row, links) in enumerate(zip(table["rows"], table["links"])):
                for c, value in enumerate(row):
                    yield t, table["caption"], r, c, table["header"][c] if c < len(table["header"]) else f"col {c + 1}", value
                yield t, table["caption"], r, len(row), "links", links

    return _udf(pages, "table_no int, caption string, row_no int, col_no int, header string, value string", cells, url, body)


DOCS_PAGE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("options", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("url", T.StringType())]))),
        T.StructField("selected", T.StringType()),
        T.StructField("items", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "date", "url")]))),
        T.StructField("missed", T.ArrayType(T.StringType())),
        T.StructField("selects", T.IntegerType()),
        T.StructField("signals", T.ArrayType(T.StringType())),
    ]
)


def read_docs_pages(pages: DataFrame, wanted: str, site_suffix: str = "", url: str = "url", body: str = "body") -> DataFrame:
    """url and the parsed page as one struct."""

    @F.pandas_udf(DOCS_PAGE)
    def parsed(bodies: pd.Series, urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([docs_page(b, u or "", wanted, site_suffix) for b, u in zip(bodies, urls)], columns=DOCS_PAGE.names)

    return pages.select(F.col(url).alias("url"), parsed(F.col(body), F.col(url)).alias("doc"))
