"""HTML as a list of text nodes with the elements they stand in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

# Elements by how they stand in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math canvas audio video textarea title".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# An element that a new one of the same list closes.
SIBLINGS = [{"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}, {"thead", "tbody", "tfoot"}]

# Elements that are never main text, and class, id and role names: all words of such a name are of the second list,
# except for those that only say where a thing stands.
BOILERPLATE = set("nav header footer aside form button select dialog menu head".split())
BOILERPLATE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice "
    "notices alert nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget share sharing "
    "social related recommended newsletter subscribe signup login search comment comments reply replies disqus popup modal "
    "toolbar pagination pager contentinfo complementary".split()
)
PLACE_NAMES = set(
    "site main top bottom left right global primary secondary inner outer bar box list item items link links button "
    "buttons form section block container wrapper wrap area slot unit panel posts icons".split()
)
# Names that begin or end with these are of reader comments, whatever the other words.
COMMENT_NAMES = set("comment comments replies disqus".split())
# In these an article is one of several, and not the page's own.
LISTS = set("aside comment comments reply replies disqus related recommended widget sidebar".split())
MAIN = {"article", "main"}
MAIN_NAMES = {"main", "main-content"}


@dataclass
class Node:
    """A run of text: its block's number, where it stands, and whether that is boilerplate or an article."""

    block: int
    path: str
    text: str
    boilerplate: bool
    article: bool


@dataclass
class _Open:
    name: str
    label: str
    boilerplate: bool
    lists: bool
    article: bool
    tail: str = field(default="")


def _label(name: str, attributes: str) -> tuple[str, set[str]]:
    """An element with its first class, and its class, id and role names."""
    names: set[str] = set()
    label = name
    if attributes:
        for kind, *values in _NAMES.findall(attributes):
            value = next((v for v in values if v), "").lower().split()
            names.update(value)
            if kind.lower() == "class" and value:
                label = f"{name}.{value[0]}"
    return label, names


def boilerplate_words(names: set[str]) -> set[str]:
    """The words of those names that are boilerplate as a whole: of ``cookie-notice``, but not of ``cookie-recipes``."""
    found: set[str] = set()
    for name in names:
        words = [w for w in re.split(r"[_:-]+", name) if w]
        known = BOILERPLATE_NAMES.intersection(words)
        if known and all(w in known or w in PLACE_NAMES or w.isdigit() for w in words):
            found |= known
        elif words and (words[0] in COMMENT_NAMES or words[-1] in COMMENT_NAMES - {"comment"}):
            found.add("comments")
    return found


def nodes(source: str) -> tuple[list[Node], list[str]]:
    """The text nodes of a page, and the path of every element that is not inline.

    Broken pages are read as browsers do in the cases that matter here: a block
    ends an open paragraph, an end tag closes all that is open inside, an end
    tag without a start is passed over, and a page may stop anywhere.
    """
    found: list[Node] = []
    paths: list[str] = []
    stack: list[_Open] = []
    block, at = 0, 0

    def text(raw: str) -> None:
        if not raw or raw.isspace():
            if raw and found and found[-1].block == block:
                found[-1].text += " "
            return
        path = stack[-1].tail if stack else ""
        boilerplate = any(o.boilerplate for o in stack)
        article = any(o.article for o in stack)
        found.append(Node(block, path, raw, boilerplate, article))

    def close(names: set[str], within: set[str]) -> None:
        """Close the innermost open one of ``names`` unless one of ``within`` is open inside it."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                del stack[k:]
                return
            if stack[k].name in within:
                return

    for token in _TOKEN.finditer(source):
        if token.start() < at:
            continue
        text(source[at : token.start()])
        name = (token[2] or "").lower()
        at = token.end()
        if not name:
            continue
        if name in INLINE:
            if not token[1] and name not in VOID:
                words = boilerplate_words(_label(name, token[3])[1])
                if words:
                    stack.append(_Open(name, name, True, bool(words & LISTS), False, stack[-1].tail if stack else ""))
            elif token[1]:
                if stack and stack[-1].name == name:
                    stack.pop()
            continue
        if name in RAW:
            # Raw text ends at its own end tag only, whatever it looks like.
            if not token[1] and not token[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
            continue
        if name == "br":
            if found and found[-1].block == block:
                found[-1].text += " "
            continue
        block += 1
        if name in VOID:
            continue
        if token[1]:
            close({name}, MAIN - {name} if name not in ("html", "body") else set())
            continue
        close({"p"}, {"article", "main", "section", "div", "td", "li", "table", "button"})
        for kin in SIBLINGS:
            if name in kin:
                close(kin, {"ul", "ol", "dl", "table", "select", "menu"})
        label, names = _label(name, token[3])
        words = boilerplate_words(names)
        lists = name == "aside" or bool(words & LISTS)
        boilerplate = name in BOILERPLATE or bool(words) and name not in ("html", "body", "main")
        article = name in MAIN or bool(names & MAIN_NAMES) and name != "body"
        if name in MAIN and not (boilerplate and lists) and not any(o.lists for o in stack):
            # The page's own article inside a menu or notice: that was never closed, or is a mere wrapper.
            boilerplate = False
            for o in stack:
                o.boilerplate = False
        stack.append(_Open(name, label, boilerplate, lists, article, f"{stack[-1].tail}>{label}" if stack else label))
        paths.append(stack[-1].tail)
    text(source[at:])
    return found, paths


def plain(raw: str) -> str:
    """A run of text with its character references decoded."""
    return html.unescape(raw) if "&" in raw else raw


def blocks(kept: list[Node]) -> list[str]:
    """The texts of the blocks that the nodes make up, white space turned into one space, none empty."""
    texts: list[list[str]] = []
    last = None
    for node in kept:
        if node.block != last:
            texts.append([])
            last = node.block
        texts[-1].append(plain(node.text))
    joined = (" ".join("".join(parts).split()) for parts in texts)
    return [t for t in joined if t]
