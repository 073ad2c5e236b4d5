"""A page's elements, their text and a hash of each subtree, in one pass over the markup.

Nothing here recurses, and each step's cost is in proportion to the markup, so deep nesting and
very long pages are no special cases.
"""

import html
import re
from hashlib import blake2b

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p "
    "pre search section select summary table tbody td template tfoot th thead title tr ul".split()
)
# A start tag that ends an open element of these kinds.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "tbody"},
}
# Elements beyond which such an open element is not looked for.
LIMITS = frozenset("table td th caption ul ol dl select button object template body html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")


class Tree:
    """Elements by number, parents before children; 0 stands for the whole page.

    `pieces` holds (block, element, text): text of one block is to be joined and its white
    space put right once it is known which elements stay.
    """

    def __init__(self, markup: str):
        self.tags, self.parents, self.attributes = ["page"], [-1], [""]
        self.hashes, self.sizes, self.ends = [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []
        self._open, self._counts, self._block = [0], {}, 0
        self._hashers = [blake2b(b"page", digest_size=8)]
        self._read(markup)
        while self._open:
            self._close()

    def _read(self, markup: str) -> None:
        at, end = 0, len(markup)
        while at < end:
            token = _TOKEN.search(markup, at)
            start = token.start() if token else end
            if start > at:
                self._text(markup[at:start])
            if not token:
                return
            at = token.end()
            name = token[2]
            if not name:
                continue
            name = name.lower()
            if token[1]:
                self._end_tag(name)
                continue
            self._start_tag(name, token[3])
            if name in RAW:
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(markup, at)
                at = closing.start() if closing else end

    def _text(self, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        self.pieces.append((self._block, self._open[-1], text))
        words = " ".join(text.split())
        if words:
            self.sizes[self._open[-1]] += len(words)
            self._hashers[-1].update(b"\x00" + words.encode("utf-8", "surrogatepass"))

    def _start_tag(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._block += 1
            self._end_open("p")
        for kind in CLOSES.get(name, ()):
            self._end_open(kind)
        if name in VOID:
            if name in ("br", "hr"):
                self.pieces.append((self._block, self._open[-1], " "))
            return
        self.tags.append(name)
        self.parents.append(self._open[-1])
        self.attributes.append(attributes)
        self.hashes.append(0)
        self.sizes.append(0)
        self.ends.append(0)
        self._open.append(len(self.tags) - 1)
        self._counts[name] = self._counts.get(name, 0) + 1
        self._hashers.append(blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8))

    def _end_open(self, name: str) -> None:
        """End the open element of that name, if there is one this side of a limit."""
        if not self._counts.get(name):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag == name:
                while len(self._open) > depth:
                    self._close()
                return
            if tag in LIMITS:
                return

    def _end_tag(self, name: str) -> None:
        if name in BLOCK:
            self._block += 1
        if not self._counts.get(name):
            return
        # An inline element is ended within its block only.
        inline = name not in BLOCK
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag == name:
                while len(self._open) > depth:
                    self._close()
                return
            if inline and tag in BLOCK or tag in ("td", "th") and name not in ("tr", "table", "tbody", "thead", "tfoot"):
                return

    def _close(self) -> None:
        node, hasher = self._open.pop(), self._hashers.pop()
        digest = hasher.digest()
        self.hashes[node] = int.from_bytes(digest, "big", signed=True)
        self.ends[node] = len(self.tags)
        if node:
            self._counts[self.tags[node]] -= 1
            self.sizes[self.parents[node]] += self.sizes[node]
            if self.sizes[node]:
                self._hashers[-1].update(b"\x01" + digest)

    def named(self, node: int) -> dict[str, str]:
        """The attributes of an element, names in lower case."""
        found = {}
        for name, double, single, bare in _ATTRIBUTE.findall(self.attributes[node]):
            found.setdefault(name.lower(), html.unescape(double or single or bare))
        return found

    def below(self, node: int) -> range:
        """The element and everything in it."""
        return range(node, self.ends[node])


def joined(pieces: list[tuple[int, int, str]], kept) -> str:
    """Text of the kept elements: one line per block, white space in it as one space."""
    blocks: dict[int, list[str]] = {}
    for block, node, text in pieces:
        if kept(node):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)
