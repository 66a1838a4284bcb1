"""A forgiving reader of HTML: block elements as a tree, text blocks in page order."""

from __future__ import annotations

import re
from html import unescape

from xxhash import xxh3_64_intdigest

#: Elements beyond this depth are nodes of their own on the page, but have the path of the one at it.
MAX_DEPTH = 64

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: What may end a tag: ">", or a quote that opens an attribute's value, which ">" inside does not end.
_STOP = re.compile(r">|=\s*([\"'])")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"\d{2,}")

#: Their content is no HTML and ends at the first end tag.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
#: Their content is HTML that is not shown as text; it ends at the end tag that belongs to it.
_HIDDEN = {"template", "svg", "object", "canvas", "annotation", "annotation-xml"}
_SAME = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I) for tag in _RAW | _HIDDEN}
#: Where the text of an unclosed raw element ends: before the next tag that structures a page.
_STRUCTURE = re.compile(
    r"<(?:/?(?:html|head|body|main|article|section|header|footer|nav|aside|div|p|h[1-6]|ul|ol|dl|table|form|figure|blockquote"
    r"|pre)|meta|link|base|script|style|title|noscript|iframe|textarea)(?=[\s/>])|\Z",
    re.I,
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
         "frame", "keygen"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "ins", "kbd", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
           "sub", "sup", "time", "tt", "u", "var", "picture", "audio", "video", "map", "wbr", "label", "img", "br",
           "input", "embed", "area", "source", "track", "param", "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext",
           "mspace", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom", "mfenced", "menclose", "msub",
           "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "none", "mtable", "mtr",
           "mlabeledtr", "mtd", "maction"}
#: A start tag ends the nearest open element of these, unless one of the others stands between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: What a page marks as not its text, by tag, role and the start of a class or id.
_NOISE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "fieldset", "dialog", "menu", "datalist", "legend"}
_NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
                "menu", "menubar", "toolbar", "tablist", "status"}
_NOISE_NAME = re.compile(
    r"(?:ad|ads|adv|advert\w*|adsense|adsby\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*|notification\w*"
    r"|alert\w*|popup|modal|overlay|newsletter|subscri\w*|signup|sign-up|login|share|sharing|social\w*|side-?bar\w*|aside|rail"
    r"|related\w*|recommend\w*|breadcrumb\w*|crumbs|menu\w*|nav|navbar|navigation|topbar|toolbar|footer|foot|header|masthead"
    r"|widget\w*|pagination|pager|search\w*|comments?|commentlist|respond|reply|replies|disqus\w*|discussion|skip-?link\w*"
    r"|copyright|outbrain|taboola|legal|disclaimer|tags|byline-share|toc-nav)(?:[-_].*)?",
    re.I,
)
#: Of these, classes (and ids of other than headings and sections) that no text of an article bears, inside it neither.
_NOISE_FOR_SURE = re.compile(
    r"(?:ads?|adv|advert|advertisement|adsense|adsby\w*|sponsored|cookies?|consent|gdpr|newsletter|comments?|commentlist|respond"
    r"|disqus\w*|outbrain|taboola|breadcrumbs?|pagination|pager|navbar|share|sharing)"
    r"(?:[-_](?:area|bar|block|box|buttons?|container|content|form|inner|links?|list|nav|notice|section|slot|thread|unit|wrap|wrapper|\d+))*",
    re.I,
)
#: Of the names of noise, those that parts of a story bear as well; outside of articles they are proof only as the name of a box.
_AMBIGUOUS = re.compile(r"(?:notice|notification|alert|widget|legal|disclaimer|tags|discussion)\w*(?:[-_].*)?", re.I)
_BOX = re.compile(
    r"(?:notices?|notifications?|alerts?|widgets?|legal|disclaimer|tags)"
    r"(?:[-_](?:area|banner|bar|block|box|container|inner|links?|list|section|wrap|wrapper|\d+))*",
    re.I,
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What running text ends with.
_SENTENCE = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")
_ROOTS = {"html", "body", "main", "article"}


class Element:
    """A block element: what it is, where it stands, and how much text and link text it holds.

    ``mark`` is why the element itself may be noise ("" if nothing says so), ``suspect`` elements are named
    like noise without proof, ``running`` ones hold a sentence or a heading, ``holds`` tells whether an
    article or main part stands in it, ``form`` is the outermost form around it.
    """

    __slots__ = ("tag", "path", "parent", "noise", "main", "mark", "suspect", "running", "holds", "form", "chars",
                 "linked", "links", "kids")

    def __init__(self, tag: str, path: str, parent: Element | None, mark: str, main: bool, suspect: bool = False):
        self.tag, self.path, self.parent, self.mark, self.main, self.suspect = tag, path, parent, mark, main, suspect
        self.noise = self.running = self.holds = False
        self.form = (parent.form if parent else None) or (self if tag == "form" else None)
        self.chars = self.linked = self.links = 0
        self.kids: list[str] = []


def _short(names: str, longest: int) -> str:
    """The names; long ones as their beginning and a digest of the whole."""
    return names if len(names) <= longest else f"{names[: longest - 17]}~{xxh3_64_intdigest(names):016x}"


def _signature(tag: str, attributes: dict[str, str]) -> str:
    names = _short(_DIGITS.sub("#", " ".join(sorted(attributes.get("class", "").split()))), 80)
    mark = _short(_DIGITS.sub("#", attributes.get("id", "")), 40)
    return f"{tag}{'.' + names if names else ''}{'#' + mark if mark else ''}".replace("/", "|").lower()


def _mark(tag: str, attributes: dict[str, str], inside_main: bool) -> str:
    """Why an element is noise by its tag, role or style, whatever its names: "sure", "form", "hidden" or ""."""
    if tag == "form":
        return "form"
    if tag in _NOISE_TAGS or tag == "label" or (tag == "header" and not inside_main):
        return "sure"
    role = attributes.get("role", "").lower()
    if role in _NOISE_ROLES:
        return "sure"
    style = attributes.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style
    return "hidden" if hidden and tag not in ("html", "body") else ""


def _named(tag: str, attributes: dict[str, str], inside_main: bool) -> tuple[bool, bool]:
    """Whether classes and id name an element as noise, and whether they only make it suspect.

    Ids of headings come from their words and say nothing. In an article, an
    article's own names, and ids of sections there and elsewhere, are no proof.
    """
    if tag in _ROOTS and tag != "article":
        return False, False
    classes, mark = attributes.get("class", "").split(), attributes.get("id", "")
    if tag in _HEADINGS:
        mark = ""
    if inside_main and tag in ("header", "h1", "h2", "h3"):
        classes, mark = [n for n in classes if not n.lower().endswith("header")], "" if mark.lower().endswith("header") else mark
    if tag == "section" and mark:
        if inside_main:
            mark = ""
        elif _NOISE_NAME.fullmatch(mark) and not any(_NOISE_NAME.fullmatch(n) for n in classes):
            return False, True
    names = [n for n in [*classes, mark] if n and _NOISE_NAME.fullmatch(n)]
    if not names:
        return False, False
    if inside_main or tag == "article":
        sure = tag not in _HEADINGS and any(_NOISE_FOR_SURE.fullmatch(n) for n in names)
    else:
        sure = any(not _AMBIGUOUS.fullmatch(n) or _BOX.fullmatch(n) for n in names)
    return sure, not sure


def _ends(html: str, tag: str) -> dict[int, int]:
    """Where the elements of a hidden tag end, by where they start; those without an end tag of their own are left out."""
    out, starts = {}, []
    for m in _SAME[tag].finditer(html):
        if not m[1]:
            if not (tag == "svg" and m[0].endswith("/>")):
                starts.append(m.start())
        elif starts:
            out[starts.pop()] = m.end()
    return out


def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
    """Where the tag whose name ends at ``at`` has its ">"; the end of the page if it has none.

    ``last`` holds the last place of either quote, so that what nothing closes is not searched for again.
    """
    while m := _STOP.search(html, at):
        quote = m[1]
        if quote is None:
            return m.start()
        at = m.end()
        if at <= last[quote]:
            at = html.index(quote, at) + 1
    return len(html)


def _settle(elements: list[Element], blocks: list[tuple[Element, str]]) -> None:
    """Decide which elements are noise, now that the whole page is known.

    Whatever is hidden or a form is none if an article stands in it. A form is
    none either if more running text stands in it than text outside of it: many
    pages stand in one form as a whole.
    """
    for e in reversed(elements[1:]):
        e.parent.holds = e.parent.holds or e.holds or e.main
    for e in elements[1:]:
        e.noise = e.parent.noise or e.mark == "sure" or (e.mark == "hidden" and not e.holds)
    forms = {id(e): e for e in elements if e.form is e}
    if forms:
        outside, inside = 0, dict.fromkeys(forms, 0)
        for e, text in blocks:
            if e.noise:
                continue
            if e.form is None:
                outside += len(text)
            elif e.tag in _HEADINGS or _SENTENCE.search(text):
                inside[id(e.form)] += len(text)
        every = outside + sum(inside.values())
        wrappers = {i for i, f in forms.items() if f.holds or 2 * inside[i] > every}
        for e in elements[1:]:
            e.noise = e.noise or e.parent.noise or (e.mark == "form" and (e.form is not e or id(e) not in wrappers))
    for e in elements:
        e.main = e.main and not e.noise


def read(html: str) -> tuple[list[Element], list[tuple[Element, str]]]:
    """The block elements of a page in order, and its blocks of text as (element, text).

    White space in a block becomes one space; character references are decoded.
    Scripts, styles, comments and other text that is not shown is left out.
    """
    root = Element("", "", None, "", False)
    elements, blocks, stack = [root], [], [root]
    parts: list[str] = []
    depths: dict[str, list[int]] = {}  # of the open elements of each tag
    ends_of: dict[str, dict[int, int]] = {}
    endless: set[str] = set()
    in_link = False
    linked = links = 0

    def nearest(tags: set[str]) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def close(depth: int) -> None:
        for e in stack[depth:]:
            depths[e.tag].pop()
        del stack[depth:]

    def raw_end(tag: str, start: int, after: int, slashed: bool) -> int:
        """Where the content of a raw or hidden element ends; ``after`` its start tag if it has none."""
        if tag in _HIDDEN:
            if tag not in ends_of:
                ends_of[tag] = _ends(html, tag)
            return ends_of[tag].get(start, after)
        if tag not in endless:
            for m in _SAME[tag].finditer(html, after):
                if m[1]:
                    return m.end()
                if slashed:  # another one starts before any ends: this one is closed as in XHTML
                    return after
            if not slashed:
                endless.add(tag)
        return after if slashed else _STRUCTURE.search(html, after).start()

    def flush() -> None:
        nonlocal linked, links
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                at = stack[-1]
                blocks.append((at, text))
                at.chars += len(text)
                at.linked += min(linked, len(text))
                at.links += links
                at.running = at.running or at.tag in _HEADINGS or bool(_SENTENCE.search(text))
        linked = links = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            linked += len(" ".join(text.split()))

    at, end = 0, len(html)
    last = {c: html.rfind(c) for c in "\"'>"}
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        stop = _tag_end(html, at, last) if at <= last[">"] else end
        if stop == end:  # a tag that never ends is cut before the next one, and quotes hold no more
            last = dict.fromkeys(last, -1) | {">": last[">"]}
            stop = _tag_end(html, at, last) if at <= last[">"] else end
            following = html.find("<", at)
            stop = stop if following < 0 or stop < end else following - 1
        rest, at = html[at:stop], min(stop + 1, end)
        in_form = bool(depths.get("form"))
        if m[1]:
            if tag == "a":
                in_link = False
            elif tag not in _INLINE or (tag == "label" and in_form):
                depth = nearest({tag})
                if depth:
                    flush()
                    in_link = False
                    close(depth)
            continue
        if tag in _RAW or tag in _HIDDEN:
            at = raw_end(tag, m.start(), at, rest.endswith("/"))
            continue
        if tag in _INLINE and not (tag == "label" and in_form):
            if tag == "a":
                in_link = True
                links += 1
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if tag in _VOID:
            continue
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        if tag in _ENDS:
            ends, stops = _ENDS[tag]
            stop = nearest(stops)
            while (depth := nearest(ends)) > stop:
                close(depth)
        up = stack[-1]
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest else {}
        sign = _signature(tag, found)
        main = up.main or tag in ("article", "main") or found.get("role", "").lower() == "main"
        sure, suspect = _named(tag, found, up.main)
        mark = "sure" if sure else _mark(tag, found, up.main)
        if mark == "sure":
            main = False  # what stands in noise is no main part, whatever its tag
        deep = len(stack) > MAX_DEPTH
        element = Element(tag, up.path if deep else f"{up.path}/{sign}", up, mark, main, suspect)
        if not deep and (not up.kids or up.kids[-1] != sign):
            up.kids.append(sign)
        elements.append(element)
        depths.setdefault(tag, []).append(len(stack))
        stack.append(element)
    flush()
    _settle(elements, blocks)
    for e in reversed(elements[1:]):  # children stand behind their parents
        e.parent.chars += e.chars
        e.parent.linked += e.linked
        e.parent.links += e.links
        e.parent.running = e.parent.running or (e.running and not e.noise)
    return elements, blocks


def digest(text: str) -> int:
    """A text as a signed 64-bit number."""
    value = xxh3_64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value
