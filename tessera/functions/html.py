"""Text of HTML pages: an Arrow-batched DOM walk for exact rules, and an expression for plain pages."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import collapse_breaks, strip

_TAGS = r"(?is)(?:<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>)"
#: Stands for a tag; no character, so no page holds it.
_MARK = "\uffff"
#: Entities that the expression decodes; the ampersand comes last, with or without its semicolon.
_ENTITIES = (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"))


def page_text(html: Column) -> Column:
    """Visible text of a plain page, each run of text on its own line, without leaving the JVM.

    Only pages without ids of their own for the text, and with no entities but the six decoded here, come
    out as ``dom_text`` gives them. Tags are taken one by one, so that their number does not matter.
    """
    text = F.regexp_replace(F.regexp_replace(html, _TAGS, _MARK), f"{_MARK}+", "\n")
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return strip(collapse_breaks(F.regexp_replace(text, "&amp;?", "&")))


#: No element has one of the two ids where this finds nothing; an entity may stand for a letter.
_MARKED = re.compile(r"""(?i:\bid)\s*=\s*["']?[^"'>\s]*(?:content|&)""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Walk(HTMLParser):
    """Collects text nodes, and what lies inside the first element that has a wanted id."""

    def __init__(self, tag: str | None = None, element_id: str | None = None, skip: tuple[str, ...] = ()):
        super().__init__(convert_charrefs=True)
        self.want, self.skip, self.texts, self.inner = (tag, element_id), skip, [], None
        self.open: list[str] = []
        self.inside: int | None = None
        self.children = self.skipping = 0
        self.fresh = True
        self.span = [0, 0]
        self.starts: list[int] = []

    def run(self, html: str) -> "_Walk":
        self.html = html
        self.starts = [0]
        for line in html.split("\n")[:-1]:
            self.starts.append(self.starts[-1] + len(line) + 1)
        self.feed(html)
        self.close()
        if self.inside is not None and self.inner is None:
            self.inner = html[self.span[0] :]
        return self

    def _at(self) -> int:
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def _break(self) -> None:
        """Text after this is another text node."""
        self.fresh = True

    def handle_comment(self, data):
        self._break()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag, attrs):
        self._break()
        if self.inside is not None and self.inner is None:
            self.children += 1
        elif self.inside is None and self.want[1] and dict(attrs).get("id") == self.want[1] and self.want[0] in (None, tag) and tag not in _VOID:
            self.inside = len(self.open)
            self.span[0] = self._at() + len(self.get_starttag_text())
        if tag in self.skip:
            self.skipping += 1
        if tag not in _VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._break()
        if self.inside is not None and self.inner is None:
            self.children += 1

    def handle_endtag(self, tag):
        self._break()
        if tag not in self.open:
            return
        while self.open:
            name = self.open.pop()
            if name in self.skip:
                self.skipping -= 1
            if self.inside is not None and self.inner is None and len(self.open) == self.inside:
                self.inner = self.html[self.span[0] : self._at()]
            if name == tag:
                return

    def handle_data(self, data):
        if data and not self.skipping:
            if self.fresh or not self.texts:
                self.texts.append(data)
            else:
                self.texts[-1] += data
            self.fresh = False


def dom_text(html: str | None) -> str:
    """Text of a decision page.

    The escaped page in ``p#hiddencontent``, where that element holds one string, is decoded once more
    and read as HTML; else the inside of ``#content`` is read, else the whole page. Scripts and styles
    go, text nodes are joined by line feeds, three or more of which become two, and the ends are stripped.
    """
    if not html:
        return ""
    source = html
    if _MARKED.search(html):
        hidden = _Walk("p", "hiddencontent").run(html)
        if hidden.inner and not hidden.children and hidden.inner.strip():
            source = unescape(unescape(hidden.inner))
        else:
            content = _Walk(None, "content").run(html)
            source = content.inner if content.inner is not None else html
    text = "\n".join(_Walk(skip=("script", "style")).run(source).texts)
    while "\n\n\n" in text:
        text = text.replace("\n\n\n", "\n\n")
    return text.strip()


@F.pandas_udf(T.StringType())
def dom_text_udf(pages: pd.Series) -> pd.Series:
    return pages.map(dom_text)
