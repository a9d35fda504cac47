"""Pages as sequences of leaf blocks: text, path of open elements, share of linked characters."""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head noscript template svg math select datalist canvas object audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
# An element that ends where one of these begins in the same parent.
ENDS = {
    "p": BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt", "option"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}

# A comment, another declaration, or a tag with its name. Comments end as browsers end them.
_MARK = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S
)
# The rest of a tag whose attributes are in good order.
_PLAIN = re.compile(r"((?:\s++[^\s/>=\"'<]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'=<>`]++))?+)*+\s*+/?+)>")
# One attribute of any other: a quote counts only right after the equals sign.
_ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(\"?)|'([^']*+)('?)|([^\s>]*+)))?+)")
_NAMES = re.compile(r"\b(class|id|role|aria-label|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAMED = frozenset("class id role aria-label itemprop".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Path:
    """An open element below others: its tag and the words of its names. Paths share what they have in common."""

    __slots__ = ("up", "entry", "depth", "sum")

    def __init__(self, up: Path | None, entry: str):
        self.up, self.entry, self.sum = up, entry, None
        self.depth = 0 if up is None else up.depth + 1

    def entries(self) -> tuple[str, ...]:
        out, at = [], self
        while at is not None:
            out.append(at.entry)
            at = at.up
        return tuple(reversed(out))


@dataclass
class Block:
    text: str
    place: Path | None
    linked: float

    @property
    def path(self) -> tuple[str, ...]:
        return self.place.entries() if self.place else ()


def names(attributes: str) -> str:
    """The words of class, id, role and label, lower-cased."""
    found = []
    for m in _NAMES.finditer(attributes):
        if m[1].lower() == "hidden":
            found.append("hidden")
        else:
            found += [w.lower() for w in _PART.findall(m[2] or m[3] or m[4] or "")]
    return " ".join(found)


def tag_rest(page: str, at: int) -> tuple[int, str, bool] | None:
    """Where a tag ends whose name ends here, its names, and whether it closes itself; None if the page ends first."""
    m = _PLAIN.match(page, at)
    if m:
        return m.end(), names(m[1]) if m[1] else "", m[1].endswith("/")
    found = []
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            return None
        at = m.end()
        if m[1]:
            return at, " ".join(found), page[at - 2] == "/"
        if (m[3] is not None and not m[4]) or (m[5] is not None and not m[6]):  # a value that never ends
            return None
        name = m[2].lower()
        if name == "hidden":
            found.append(name)
        elif name in _NAMED:
            found += [w.lower() for w in _PART.findall(m[3] or m[5] or m[7] or "")]


class _Open:
    """The open elements, with those of each tag and the blocks among them by place."""

    def __init__(self):
        self.tags: list[str] = []
        self.places: list[Path | None] = []  # the path below each
        self.by_tag: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.unseen = self.links = 0

    def place(self) -> Path | None:
        return self.places[-1] if self.places else None

    def push(self, tag: str, words: str) -> None:
        self.by_tag.setdefault(tag, []).append(len(self.tags))
        if tag in BLOCK:
            self.blocks.append(len(self.tags))
        shown = tag in BLOCK or tag == "a" or words
        up = self.place()
        self.tags.append(tag)
        self.places.append(Path(up, f"{tag} {words}" if words else tag) if shown else up)
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def pop_to(self, size: int) -> None:
        while len(self.tags) > size:
            tag = self.tags.pop()
            self.places.pop()
            self.by_tag[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order, references decoded, white space of a block made one space. Null: none.

    The time it takes grows with the page, whatever is open or stray in it.
    """
    out: list[Block] = []
    if not page:
        return out
    stack = _Open()
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = _SPACE.sub(" ", "".join(text)).strip()
            if joined:
                out.append(Block(joined, stack.place(), min(1.0, linked / len(joined))))
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not stack.unseen:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if stack.links:
                linked += len(piece.strip())

    at, end = 0, len(page)
    while at < end:
        m = _MARK.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        rest = tag_rest(page, at)
        if rest is None:  # the page breaks off within a tag
            break
        at, words, closed = rest
        if m[1]:
            own = stack.by_tag.get(tag)
            if tag == "br":
                add(" ")
            elif own:
                if tag in BLOCK or tag in UNSEEN:
                    flush()
                    stack.pop_to(own[-1])
                elif not stack.blocks or stack.blocks[-1] < own[-1]:
                    # An inline element ends within others; blocks stay open.
                    stack.pop_to(own[-1])
            continue
        if tag in RAW:
            close = _closing(tag).search(page, at)
            at = close.end() if close else end
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            flush()
            for k in reversed(stack.blocks):
                open_ = stack.tags[k]
                if tag in ENDS.get(open_, ()):
                    stack.pop_to(k)
                    break
                if open_ not in ENDS:
                    break
        if tag in VOID or closed:
            continue
        stack.push(tag, words)
    flush()
    return out


@functools.cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)
