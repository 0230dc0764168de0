"""Leaf blocks of a web page: runs of text between block-level tags, with the tags above them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("canvas iframe math noembed noframes noscript object script style svg template textarea title xmp".split())
#: An opening tag that ends an open element of the same group, unless a bound stands between.
ENDS = {t: (group, bound) for group, bound in (
    (("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("option",), ("select",)), (("tr",), ("table",)),
    (("td", "th"), ("table", "tr")),
) for t in group}
KEEPS_P = frozenset("body html button label option td th caption".split())  # tags that do not end a paragraph

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|style)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    """Text with its references decoded and white space folded; characters of it in links; tags above, outermost first."""

    text: str
    linked: int
    path: tuple[tuple[str, tuple[str, ...]], ...]


def names(attributes: str) -> tuple[str, ...]:
    """Words of the attributes that tell what an element is for."""
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    found = []
    for key, value, hidden in _ATTRIBUTE.findall(attributes):
        if hidden:
            found.append("hidden")
        elif key.lower() == "style":
            if "none" in value.replace(" ", "") and "display" in value:
                found.append("hidden")
        else:
            found += _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
    return tuple(dict.fromkeys(found))


def blocks(html: str | None) -> list[Block]:
    """All leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = links = 0
    at, html = 0, html or ""

    def close() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, min(linked, len(text)), tuple(stack)))
            held.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = unescape(raw) if "&" in raw else raw
        held.append(text)
        if links:
            linked += len(text.strip())

    def drop(place: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[place:])
        del stack[place:]

    while True:
        token = _TOKEN.search(html, at)
        if token is None:
            say(html[at:])
            break
        if token.start() > at:
            say(html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if tag in BLOCKS:
                close()
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if place is not None:
                drop(place)
            continue
        if tag in UNREAD:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = len(html) if end is None else end.end()
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCKS:
            close()
            if tag not in KEEPS_P:
                place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
                if place is not None:
                    drop(place)
            if tag in ENDS:
                group, bound = ENDS[tag]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in bound:
                        break
                    if stack[i][0] in group:
                        drop(i)
                        break
        if tag not in VOID and not token[3].endswith("/"):
            stack.append((tag, names(token[3])))
            links += tag == "a"
    close()
    return out
