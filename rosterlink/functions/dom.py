"""What the jobs need of a page: its tables, headings with tables, paragraphs and intro, as one nested column.

A page is parsed once, in Arrow batches, and ``parsed_pages`` writes the result; everything after is relational and reads
only the fields it needs. A table's ``header`` holds the normalised texts of its first row. Tags nest as they come: an end tag closes the
nearest open tag of its name (and is ignored if there is none), void tags close at once, and text leaves out comments
and what scripts, styles and templates hold.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rosterlink.sources.written import materialise

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template".split())
HEADINGS = ("h2", "h3", "h4")
#: Tags whose content has rules of its own.
SPECIAL = frozenset("iframe math noembed noframes noscript plaintext script style svg template textarea title xmp".split())
#: What is between ``<`` and ``>`` of a tag in lower case with double-quoted attributes, as most are.
_PLAIN = re.compile(r'(/?)([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>&]*")*)(/?)')
_ATTR = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
#: Short plain tags by their text, as ``_plain_tag`` reads them: those that a worker met last, as most come again.
_tags: dict[str, tuple[str, str, dict]] = {}
_MOST_TAGS, _LONGEST_TAG = 4000, 200

_CELL = "struct<tag:string,text:string,link_title:string,link_text:string,has_link:boolean,bday:string,time_datetime:string,time_text:string>"
DOM = (
    f"struct<tables:array<struct<pos:int,is_wikitable:boolean,cls:string,index:int,header:array<string>,rows:array<array<{_CELL}>>>>,"
    "heading_tables:array<struct<heading_text:string,table_pos:int>>,"
    "paragraphs:array<struct<pos:int,text:string,is_direct_child:boolean>>,intro_parts:array<string>>"
)


class _Node:
    """An element: ``nodes`` and ``texts`` of its page hold what is in it from ``at + 1`` and ``first`` up to ``end`` and ``last``."""

    __slots__ = ("tag", "attrs", "children", "parent", "at", "end", "first", "last", "silent")

    def __init__(self, tag, attrs, parent=None, at=-1, first=0):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.at, self.end, self.first, self.last = at, at + 1, first, first
        # scripts and the like around a text, itself included
        self.silent = (parent.silent if parent else 0) + (tag in SILENT)

    def classes(self):
        return (self.attrs.get("class") or "").split()


def _plain_tag(text: str) -> tuple[str, str, dict] | None:
    """``(kind, tag, attributes)`` of a tag's text, the kind being ``/`` (end), `` /`` (closed at once) or nothing; null if it isn't plain."""
    m = _PLAIN.fullmatch(text)
    if m is None:
        return None
    end, tag, attrs, closed = m.groups()
    if tag in SPECIAL or (end and (attrs or closed)):
        return None
    return end or (" /" if closed else ""), tag, dict(_ATTR.findall(attrs))


def _digests(nodes: list[_Node]) -> dict[int, bytes]:
    """A digest of every element's content by ``id``, each made once from those of its children; equal for equal content."""
    out: dict[int, bytes] = {}
    for node in reversed(nodes):  # children come before their parents
        h = hashlib.blake2b(repr((node.tag, sorted(node.attrs.items(), key=str))).encode("utf-8", "surrogatepass"), digest_size=16)
        for c in node.children:
            part = c.encode("utf-8", "surrogatepass") if isinstance(c, str) else out[id(c)]
            h.update(b"%d%c" % (len(part), b"se"[not isinstance(c, str)]) + part)
        out[id(node)] = h.digest()
    return out


def _equal_tables(page: _Builder, tables: list[_Node]) -> dict[int, int]:
    """The place of the first table of equal content for each of ``tables`` by ``id``; digests only where sizes agree."""
    if len(tables) < 2:
        return {}
    size = lambda t: (t.end - t.at, t.last - t.first)
    sizes = Counter(map(size, tables))
    alike = [t for t in tables if sizes[size(t)] > 1]
    digest, covered = {}, -1
    for t in alike:
        if t.at > covered:  # one pass for the tables within it, too
            digest |= _digests(page.nodes[t.at : t.end])
            covered = t.end - 1
    first: dict[bytes | int, int] = {}
    return {id(t): first.setdefault(digest.get(id(t), id(t)), k) for k, t in enumerate(tables)}


def _next_tables(nodes: list[_Node]) -> dict[int, _Node]:
    """For every heading the next table beside it, if there is one: one pass over the elements from the last."""
    out: dict[int, _Node] = {}
    table: dict[int, _Node] = {}
    for c in reversed(nodes):
        if c.tag == "table":
            table[id(c.parent)] = c
        elif c.tag in HEADINGS and id(c.parent) in table:
            out[id(c)] = table[id(c.parent)]
    return out


class _Builder(HTMLParser):
    """A page's elements and texts, each in one list in the order of the page, so that what is in an element is a slice."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {})
        self.nodes, self.texts, self.silent = [], [], []

    def read(self, html: str) -> None:
        """The whole page: plain tags and texts from its start as they come, the standard parser from the first other thing on."""
        self.feed(html[self._read_plain(html) :])
        self.close()

    def _read_plain(self, html: str) -> int:
        """Read plain tags and texts as far as they go; where the first other thing is. An ``&``, or a text that no tag follows, is one."""
        before, *parts = html.split("<")
        if not parts or "&" in before:
            return 0
        nodes, texts, silent, at = self.nodes, self.texts, self.silent, self.at
        if before:
            self.handle_data(before)
        done, last = len(before), len(parts) - 1
        for k, part in enumerate(parts):
            name, end, text = part.partition(">")
            known = _tags.get(name)
            if known is None:
                known = _plain_tag(name)
                if known is not None and len(name) <= _LONGEST_TAG:
                    if len(_tags) >= _MOST_TAGS:
                        _tags.clear()
                    _tags[name] = known
            if known is None or not end:
                break
            kind, tag, attrs = known
            if kind == "/":
                if at.tag == tag:
                    at.end, at.last = len(nodes), len(texts)
                    at = at.parent
                else:
                    self.at = at
                    self.handle_endtag(tag)
                    at = self.at
            else:
                node = _Node(tag, attrs, at, len(nodes), len(texts))
                nodes.append(node)
                at.children.append(node)
                if not kind and tag not in VOID:
                    at = node
            if text:
                if k == last or "&" in text:
                    done += len(name) + 2
                    break
                texts.append(text)
                silent.append(at.silent)
                at.children.append(text)
            done += len(part) + 1
        self.at = at
        return done

    def _add(self, tag, attrs):
        node = _Node(tag, dict(attrs), self.at, len(self.nodes), len(self.texts))
        self.nodes.append(node)
        self.at.children.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        node = self._add(tag, attrs)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self._leave(node.parent)

    def handle_data(self, data):
        self.texts.append(data)
        self.silent.append(self.at.silent)
        self.at.children.append(data)

    def close(self):
        super().close()
        self._leave(None)

    def _leave(self, parent):
        """Every open element below ``parent`` ends here."""
        while self.at is not parent:
            self.at.end, self.at.last = len(self.nodes), len(self.texts)
            self.at = self.at.parent

    def all(self, node, *tags):
        return [n for n in self.nodes[node.at + 1 : node.end] if n.tag in tags]

    def text(self, node) -> str:
        if node.tag in SILENT:
            return ""
        part = self.texts[node.first : node.last]
        silent = self.silent[node.first : node.last]
        if silent.count(node.silent) < len(silent):
            part = [t for t, k in zip(part, silent) if k == node.silent]
        return "".join(part)


def _cell(page: _Builder, c: _Node) -> dict:
    link = time = bday = None
    for n in page.nodes[c.at + 1 : c.end]:
        if n.tag == "a":
            link = link or n
        elif n.tag == "time":
            time = time or n
        elif n.tag == "span" and bday is None and "bday" in n.classes():
            bday = n
    return {
        "tag": c.tag, "text": page.text(c), "has_link": link is not None, "link_title": link.attrs.get("title") if link else None, "link_text": page.text(link) if link else None,
        "bday": page.text(bday) if bday else None, "time_datetime": time.attrs.get("datetime") if time else None, "time_text": page.text(time) if time else None,
    }


def parse(html: str | None, content: tuple[str, str | None] = ("div", "mw-parser-output")) -> dict:
    """The nested value of one page; ``content`` is the tag and class (None: any) of the container of its paragraphs."""
    page = _Builder()
    page.read(html or "")
    tables = page.all(page.root, "table")
    place = {id(t): k for k, t in enumerate(tables)}
    wiki = [t for t in tables if "wikitable" in t.classes()] or tables
    index = _equal_tables(page, wiki)
    out = []
    for k, t in enumerate(tables):
        rows = [[_cell(page, c) for c in page.all(r, "td", "th")] for r in page.all(t, "tr")]
        header = [" ".join(c["text"].lower().split()) for c in rows[0]] if rows else []
        out.append({"pos": k, "is_wikitable": "wikitable" in t.classes(), "cls": " ".join(t.classes()), "index": index.get(id(t), 0), "header": header, "rows": rows})
    after = _next_tables(page.nodes) if tables else {}
    headings = [{"heading_text": page.text(h), "table_pos": place[id(after[id(h)])]} for h in page.all(page.root, *HEADINGS) if id(h) in after]
    box = next((n for n in page.all(page.root, content[0]) if content[1] is None or content[1] in n.classes()), None)
    paragraphs, intro = [], []
    if box is not None:
        paragraphs = [{"pos": k, "text": page.text(p), "is_direct_child": p.parent is box} for k, p in enumerate(page.all(box, "p"))]
        for c in box.children:
            if isinstance(c, _Node):
                if c.tag == "p":
                    if text := page.text(c).strip():
                        intro.append(text)
                elif c.tag in ("h2", "h3", "table"):
                    break
    return {"tables": out, "heading_tables": headings, "paragraphs": paragraphs, "intro_parts": intro}


def with_dom(pages: DataFrame, html_col: str = "html", content: tuple[str, str | None] = ("div", "mw-parser-output")) -> DataFrame:
    """``pages`` with ``dom`` in the place of the HTML. A null or empty page has no tables and no paragraphs."""
    from pyspark.sql.pandas.types import to_arrow_type

    keep = [f for f in pages.schema.fields if f.name != html_col]
    dom_type = to_arrow_type(T._parse_datatype_string(DOM))
    names = [f.name for f in keep]

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index(html_col)
            for lo in range(0, batch.num_rows, 64):  # pages can be large: few at once
                part = batch.slice(lo, 64)
                doms = pa.array([parse(h.as_py(), content) for h in part.column(at)], dom_type)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.names.index(n)) for n in names), doms], [*names, "dom"])

    schema = T.StructType([*keep, T.StructField("dom", T._parse_datatype_string(DOM))])
    return pages.mapInArrow(run, schema)


def parsed_pages(pages: DataFrame, html_col: str = "html", content: tuple[str, str | None] = ("div", "mw-parser-output")) -> DataFrame:
    """``with_dom``, written once: no later job parses a page again."""
    return materialise(with_dom(pages, html_col, content))
