"""HTML pages as sequences of text blocks with the path of open elements above each."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select button".split())
#: of these an open one without an end holds the rest of the page; the others are then passed over
TO_THE_END = frozenset("script style textarea title iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder semantics".split()
)
#: what may stand in the head; all else opens the body
IN_HEAD = frozenset("base basefont bgsound link meta title script style noscript template".split())
DEEPEST = 512  # as in browsers, an element opened below this depth becomes a sibling
#: opening one of these ends an open one of the same kind below the same parent
CLOSES_ITSELF = {"p": "p", "li": "li ul ol", "dt": "dt dd dl", "dd": "dt dd dl", "tr": "tr table", "td": "td th tr", "th": "td th tr", "option": "option"}
#: block elements that end an open paragraph
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]++", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>")
_STARTS = re.compile(r"<[a-zA-Z!?/]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # element names, and words of class, id and role as ".word"
    link_chars: int


def _labels(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = [a or b or c for a, b, c in _NAMES.findall(attributes)]
    return tuple(f".{w.lower()}" for value in found for w in _PART.findall(value))


def blocks(page: str | None) -> list[Block]:
    """Blocks in page order: text between block-level tags, white space as single spaces, without script, style,
    comments, form controls and the head.

    Defined cases: stray and unclosed tags are tolerated; the head ends where the body's first element or text stands;
    a tag that the page ends in is dropped; after a tag with an unpaired quote, tags end at the next ``>``. Every
    character is looked at a bounded number of times, so broken pages take no longer than sound ones.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # open elements: name and path down to it
    text: list[str] = []
    links = 0
    opened: Counter[str] = Counter()  # open elements by name
    loose, endless = False, set()

    def cut(k: int) -> None:
        for name, _ in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    def flush() -> None:
        nonlocal links
        if text:
            plain = " ".join("".join(text).split())
            if plain:
                out.append(Block(plain, stack[-1][1] if stack else (), min(links, len(plain))))
            text.clear()
        links = 0

    def close(name: str) -> None:
        if not opened[name]:
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                if any(s not in INLINE for s, _ in stack[k:]):
                    flush()
                cut(k)
                return
            if name in INLINE and stack[k][0] not in INLINE:
                return  # a stray inline end never closes a block

    page, at = page or "", 0
    while at < len(page):
        m = None if loose and page[at] == "<" and not page.startswith("<!--", at) else _TOKEN.match(page, at)
        if m is None and _STARTS.match(page, at):
            m = _LOOSE.match(page, at) if page.find(">", at) >= 0 else None
            loose = True
            if m is None:
                break  # the page ends in this tag
        at, name, piece = (m.end(), m[2], m[0]) if m else (at + 1, None, page[at])
        if name is None:
            if not _STARTS.match(piece):
                if opened["head"] and not piece.isspace():
                    close("head")
                piece = html.unescape(piece) if "&" in piece else piece
                text.append(piece)
                if opened["a"]:
                    links += len(piece.strip())
            continue
        name = name.lower()
        if m[1]:
            if name == "br":
                text.append(" ")
            else:
                if name not in INLINE:
                    flush()
                close(name)
            continue
        attributes = m[3]
        if opened["head"] and name not in IN_HEAD:
            close("head")
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at) if name not in endless else None
            if name not in ("svg", "button"):
                flush()
            if end or name in TO_THE_END:
                at = end.end() if end else len(page)  # its content is no text
            else:
                endless.add(name)
            continue
        if name in ("br", "wbr", "img"):
            text.append(" " if name == "br" else "")
            continue
        if name not in INLINE:
            flush()
            if name in ENDS_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        cut(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            if name in CLOSES_ITSELF and name != "p":
                stops = CLOSES_ITSELF[name].split()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in stops:
                        if stack[k][0] in ("li", "dt", "dd", "tr", "td", "th", "option") and (stack[k][0] == name or name in ("dt", "dd", "td", "th") and stack[k][0] != "tr"):
                            cut(k)
                        break
        if name not in VOID and not attributes.endswith("/"):
            if len(stack) >= DEEPEST:
                cut(DEEPEST - 1)
            labels, above = _labels(attributes), stack[-1][1] if stack else ()
            stack.append((name, (*above, name, *labels) if name not in INLINE or labels else above))
            opened[name] += 1
    flush()
    return out
