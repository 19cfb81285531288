"""Visible text of HTML pages: a tokenizer as a state machine, over Arrow batches.

States follow the HTML standard: data, tag (with its attributes, whose quoted
values may hold ``>``), comment and other markup declarations, and raw text of
elements that hold no markup.

Rules:

* Every tag, comment and hidden part counts as a space; runs of white space are
  one space, and the text is stripped. A null page has null text.
* ``script``, ``style``, ``title``, ``iframe``, ``noembed`` and ``noframes`` hold raw text
  that is not shown, up to their own end tag or, where that is missing, the end of
  the page. ``textarea`` and ``xmp`` hold raw text that is shown.
* ``template`` and every element with the attribute ``hidden`` are not shown, with all
  they hold. They end at their end tag, at the end tag of an element around
  them, or, where end tags may be left out (``p``, ``li``, ``dt``, ``dd``, ``option``,
  table rows and cells), at the next tag that ends them.
* ``<`` that no letter, ``/``, ``!`` or ``?`` follows is text. Comments end at ``-->`` or
  ``--!>`` or with the page; ``<!...>``, ``<?...>`` and ``</`` before anything but a letter
  end at the next ``>``.
* A tag that never ends takes the rest of the page, which browsers drop as
  well. A quote that never ends does not: it counts as part of a name.
* Entities are those of HTML 5 that end in a semicolon, and numbers; each is
  decoded once, a hard space as a space, and what is no character stays as it is.
"""

from __future__ import annotations

import re
from collections import Counter
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

# Kinds of elements.
RAW_HIDDEN = frozenset("script style title iframe noembed noframes".split())
RAW_SHOWN = frozenset("textarea xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: Tags that end an element whose own end tag is left out.
ENDED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "optgroup": frozenset(["optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}

SPACE = r"[ \t\n\r\f\x0b]"
NAME = re.compile(r"[A-Za-z][^\s/>]*+")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++))?+""")
ATTRIBUTES = re.compile(rf"(?:[\s/]++|{ATTRIBUTE.pattern})*+>")
COMMENT_END = re.compile(r"--!?>")
ENTITY = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);")
BLANKS = re.compile(f"{SPACE}+")
STRIPPED = " \t\n\r\f\x0b"


def character(found: re.Match) -> str:
    """The character of an entity; the entity itself where it stands for none."""
    name = found.group(1)
    if not name.startswith("#"):
        made = html5.get(f"{name};", found.group())
    else:
        code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        usable = 0 < code < 0xD800 or 0xE000 <= code < 0x110000
        made = chr(code) if usable else found.group()
    return " " if made == "\xa0" else made


class Page:
    """One page while it is read: where the reader is, what is shown, and what is open."""

    def __init__(self, source: str) -> None:
        self.source, self.at = source, 0
        self.out: list[str] = []
        self.open: list[str] = []
        self.counts: Counter[str] = Counter()
        #: Open elements from the hidden one on; empty while text is shown.
        self.hidden: list[str] = []

    def show(self, text: str) -> None:
        if not self.hidden:
            self.out.append(text)

    def text(self) -> str:
        source, size = self.source, len(self.source)
        while self.at < size:
            start = source.find("<", self.at)
            if start < 0:
                self.show(source[self.at :])
                break
            self.show(source[self.at : start])
            self.at = start + 1
            follows = source[self.at : self.at + 1]
            if follows.isascii() and follows.isalpha():
                self.start_tag()
            elif follows == "/":
                self.end_tag()
            elif follows in ("!", "?"):
                self.declaration()
            else:
                self.show("<")
                continue
            self.show(" ")
        made = "".join(self.out)
        if "&" in made:
            made = ENTITY.sub(character, made)
        return BLANKS.sub(" ", made).strip(STRIPPED)

    def skip_past(self, end: int) -> None:
        """Go on behind a place; -1 stands for the end of the page."""
        self.at = len(self.source) if end < 0 else end

    def declaration(self) -> None:
        source = self.source
        if not source.startswith("!--", self.at):
            end = source.find(">", self.at)
            self.skip_past(end + 1 if end >= 0 else -1)
            return
        body = self.at + 3
        for short in (">", "->"):
            if source.startswith(short, body):
                self.skip_past(body + len(short))
                return
        found = COMMENT_END.search(source, body)
        self.skip_past(found.end() if found else -1)

    def end_tag(self) -> None:
        source = self.source
        found = NAME.match(source, self.at + 1)
        if found is None:
            end = source.find(">", self.at)
            self.skip_past(end + 1 if end >= 0 else -1)
            return
        rest = ATTRIBUTES.match(source, found.end())
        self.skip_past(rest.end() if rest else -1)
        if rest:
            self.close(found.group().lower())

    def start_tag(self) -> None:
        source = self.source
        found = NAME.match(source, self.at)
        name = found.group().lower()
        rest = ATTRIBUTES.match(source, found.end())
        if rest is None:
            self.skip_past(-1)
            return
        self.skip_past(rest.end())
        while self.hidden and name in ENDED_BY.get(self.hidden[-1], ()):
            self.hidden.pop()
        if name in RAW_HIDDEN or name in RAW_SHOWN:
            self.raw(name)
        elif name not in VOID:
            attributes = rest.group()
            named = "hidden" in attributes.lower() and any(m.group(1).lower() == "hidden" for m in ATTRIBUTE.finditer(attributes[:-1]))
            if self.hidden or named or name == "template":
                self.show(" ")
                self.hidden.append(name)
            else:
                self.open.append(name)
                self.counts[name] += 1

    def raw(self, name: str) -> None:
        found = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(self.source, self.at)
        end = found.start() if found else len(self.source)
        if name in RAW_SHOWN:
            self.show(" " + self.source[self.at : end])
        self.skip_past(end)
        if found:
            rest = ATTRIBUTES.match(self.source, found.end())
            self.skip_past(rest.end() if rest else -1)

    def close(self, name: str) -> None:
        """An end tag closes the innermost element of its name and all within that."""
        if name in self.hidden:
            while self.hidden.pop() != name:
                pass
            return
        if self.counts[name]:
            self.hidden.clear()
            while (inner := self.open.pop()) != name:
                self.counts[inner] -= 1
            self.counts[name] -= 1


def visible_text(source: str | None) -> str | None:
    return None if source is None else Page(source).text()


def html_text(html: Column) -> Column:
    """Visible text of a page."""

    def run(pages: pa.Array) -> pa.Array:
        return pa.array((visible_text(x.as_py()) for x in pages), pa.string())

    return arrow_udf(run, "string")(html)
