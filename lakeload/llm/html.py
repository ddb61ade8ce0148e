"""The main text of web pages, by templates deduced from pages of the same host.

A page is a sequence of tokens: its elements, by their path, and its pieces of text, by path and
wording. Tokens of a host that occur equally often on every page have the same occurrence vector
and make an equivalence class; a large one is valid if the classes of the elements around its tokens
lie one within the other, and its text belongs to the template if most pages that have its element
have it. What fills the slots of a template differs from page to page: the text, and elsewhere
menus, adverts and the like, which their elements give away. A page goes down from slot to slot as
long as one holds most, so pages of several layouts each come to their own.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.storage import stored
from lakeload.names import column

#: Text is part of a template if this share of the pages that have its element has it, and so many
#: pages do, and so many tokens are in its class.
SHARE = 0.5
LEAST_PAGES = 3
LEAST_TOKENS = 4
#: A layout of its own has this share of a host's pages.
LAYOUT = 0.1
#: The slot within a slot that has this share of its text holds the article.
MOST = 0.75
#: Templates are broadcast up to so many bytes; beyond, those of the hosts with most pages are, up to
#: so many hosts and bytes, and the others joined.
BROADCAST_BYTES = 64 << 20
HOT_HOSTS = 1000

# Elements by what they do to text.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_SIDE = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "select", "button", "fieldset"}
_SIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
_SIDE_WORDS = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promoted promotion related "
    "replies search share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that also name parts of an article: within one they tell nothing by themselves.
_DOUBTFUL_WORDS = set(
    "banner header login masthead menu notice notices promoted related search skip social widget".split()
)
#: Elements that hold an article's own text, whatever words their names have.
_TEXT_ELEMENTS = set(
    "section h1 h2 h3 h4 h5 h6 hgroup p ul ol li dl dt dd table tbody thead tfoot tr td th "
    "blockquote pre figure figcaption details summary".split()
)
_NEVER_ON_ARTICLES = {"comment", "comments", "replies", "ad", "ads", "advert", "related", "promo"}
# Elements that can be the slot an article is in, where a page has them once.
_SLOTS = {"html", "body", "main", "article", "section", "div", "center", "td"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>", re.S
)
_NAME_END = re.compile(r"[\s/>]|\Z")
_MARK = re.compile(r"[>\"']|\Z")
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/]+)")
_SPLIT = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"[0-9]+")


@dataclass(eq=False)
class Element:
    """An element that is open, and the one ``around`` it.

    ``token`` stands for the names of this element and of those around it, ``number`` for the place
    where it opens. ``side`` tells that it is not part of an article, ``article`` that it is one, both
    also of what is in it; ``doubt`` that it is not part of one if most pages of the host have it,
    ``doubtful`` that this holds for it or for one around it.
    """

    tag: str
    token: int
    number: int
    around: Element | None = field(repr=False)
    side: bool
    article: bool
    header: bool
    heading: bool
    doubt: bool
    doubtful: bool


@dataclass(frozen=True)
class Block:
    """Text between two boundaries of blocks, and the innermost ``element`` around it, if any."""

    text: str
    element: Element | None
    side: bool

    @property
    def article(self) -> bool:
        return bool(self.element and self.element.article)

    @property
    def doubtful(self) -> bool:
        return bool(self.element and self.element.doubtful)

    @property
    def around(self) -> int:
        """The token of the element around it; 0 if there is none."""
        return self.element.token if self.element else 0

    @property
    def token(self) -> int:
        return _hashed(str(self.around), self.text)


class _Stack:
    """The elements that are open, and how many of each tag."""

    def __init__(self) -> None:
        self._open: list[Element] = []
        self._tags: Counter[str] = Counter()

    @property
    def top(self) -> Element | None:
        return self._open[-1] if self._open else None

    def push(self, element: Element) -> None:
        self._open.append(element)
        self._tags[element.tag] += 1

    def pop(self) -> str:
        tag = self._open.pop().tag
        self._tags[tag] -= 1
        return tag

    def has(self, tag: str) -> bool:
        return self._tags[tag] > 0

    def close(self, tag: str) -> None:
        if self.has(tag):
            while self.pop() != tag:
                pass

    def make_room(self, tag: str) -> None:
        """A block ends a paragraph that is open, a list item the one before it, and so on."""
        while self.top and self.top.tag == "p":
            self.pop()
        while self.top and self.top.tag in _CLOSED_BY.get(tag, ()):
            self.pop()


class _Tags:
    """The tags, comments and declarations of a page, in time linear in its length.

    What looks like a tag but has no end is text. From the first of these on, no part of the page is
    looked through twice: a place from which no end was found has none for a later tag either.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self._last = page.rfind(">")
        self._careful = False
        self._hopeless: set[int] = set()
        # Where the last search began, and what it came to.
        self._name = self._mark = (0, -1)

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Of the first one from ``at`` on: its start and end, whether it closes an element, the
        tag (none for a comment or declaration) and the attributes."""
        while (at := self.page.find("<", at)) >= 0:
            found = self._at(at) if self._careful else self._matched(at)
            if found:
                return found
            at += 1
        return None

    def _matched(self, at: int) -> tuple[int, int, bool, str, str] | None:
        match = _TAG.match(self.page, at)
        if match:
            return at, match.end(), bool(match[1]), (match[2] or "").lower(), match[3] or ""
        self._careful = self.page[at + 1 : at + 2] not in ("", " ", "<")
        return None

    def _at(self, at: int) -> tuple[int, int, bool, str, str] | None:
        page = self.page
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return at, len(page) if end < 0 else end + 3, False, "", ""
        if at > self._last:
            return None
        if page.startswith(("<!", "<?"), at):
            return at, page.index(">", at) + 1, False, "", ""
        closing = page.startswith("/", at + 1)
        first = at + 1 + closing
        letter = page[first : first + 1]
        if not (letter.isascii() and letter.isalpha()):
            return None
        if not self._name[0] <= first <= self._name[1]:
            self._name = (first, _NAME_END.search(page, first).start())
        name_end = self._name[1]
        if not self._mark[0] <= name_end <= self._mark[1]:
            self._mark = (name_end, _MARK.search(page, name_end).start())
        mark, met = self._mark[1], []
        while mark < len(page) and page[mark] != ">" and mark not in self._hopeless:
            met.append(mark)
            quoted = page.find(page[mark], mark + 1)
            mark = len(page) if quoted < 0 else _MARK.search(page, quoted + 1).start()
        if mark < len(page) and page[mark] == ">":
            return at, mark + 1, closing, page[first:name_end].lower(), page[name_end:mark]
        self._hopeless.update(met)
        return None


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare, lone in _ATTRIBUTE.findall(source):
        found.setdefault((name or lone).lower(), html.unescape(double or single or bare))
    return found


def _named(tag: str, attributes: dict[str, str], in_article: bool) -> tuple[bool, bool]:
    """Whether an element's names tell that it is no part of an article, and whether they may.

    A name tells it if all its words do: ``share`` and ``ad-1``, but not ``section-header``. Where
    only some do, or within an article only doubtful ones, or the element is one of an article's
    own text, it takes the template to confirm it; ids of the latter are links to them and tell
    nothing.
    """
    names = attributes.get("class", "").lower().split()
    if tag not in _TEXT_ELEMENTS:
        names += attributes.get("id", "").lower().split()
    sure = doubt = False
    for name in names:
        words = [word for word in _SPLIT.split(name) if word and not word.isdigit()]
        telling = [word for word in words if word in _SIDE_WORDS]
        doubt = doubt or bool(telling)
        whole = len(telling) == len(words) > 0
        sure = sure or whole and not (in_article and all(word in _DOUBTFUL_WORDS for word in words))
    return sure and tag not in _TEXT_ELEMENTS, doubt


def _opened(tag: str, source: str, around: Element | None, number: int) -> Element:
    attributes = _attributes(source) if source.strip(" /") else {}
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    role = attributes.get("role", "").lower()
    main = tag in ("article", "main") or role in ("main", "article")
    in_article = bool(around and around.article)
    side = doubt = header = False
    if main:
        side = bool(set(_SPLIT.split(names)) & _NEVER_ON_ARTICLES)
    elif tag not in ("html", "body"):
        sure, doubt = _named(tag, attributes, in_article) if attributes else (False, False)
        side = tag in _SIDE or role in _SIDE_ROLES or sure
        # What heads an article or a section is not page furniture, however many pages have it.
        header = tag == "header" or (in_article and "header" in _SPLIT.split(names) and not side)
    doubt = doubt and not side and not header
    side = side or "hidden" in attributes
    side = side or (header and not in_article)
    name = _path_name(tag, attributes) if attributes else tag
    return Element(
        tag,
        _below(around.token if around else 0, name),
        number,
        around,
        bool(around and around.side) or side,
        in_article or main,
        bool(around and around.header) or tag == "header",
        bool(around and around.heading) or tag in _HEADINGS,
        doubt,
        bool(around and around.doubtful) or doubt,
    )


def _path_name(tag: str, attributes: dict[str, str]) -> str:
    """An element's name in paths: what tells elements of a page apart, but not pages.

    Numbers in classes count as equal. Ids with a number or of many words are of one page, as are
    those of an article and of its own elements.
    """
    names = sorted({_DIGITS.sub("0", name) for name in attributes.get("class", "").lower().split()})
    own = attributes.get("id", "").lower()
    if own and tag not in _TEXT_ELEMENTS and tag != "article":
        if not _DIGITS.search(own) and len(_SPLIT.split(own)) <= 2:
            names.append("#" + "".join(own.split()))
    return ".".join([tag, *names])


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page, in order; markup that is not closed ends with what is around it."""
    page = page or ""
    found: list[Block] = []
    stack = _Stack()
    pieces: list[str] = []

    def end_block() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            top = stack.top
            # Of a header inside an article only headings are text.
            lost = bool(top and top.header and not top.heading)
            found.append(Block(text, top, bool(top and top.side) or lost))

    at, tags = 0, _Tags(page)
    while next_ := tags.after(at):
        start, end, closing, tag, source = next_
        pieces.append(page[at:start])
        at = end
        if not tag:
            continue
        if tag in _RAW and not closing:
            match = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = match.end() if match else len(page)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in _BLOCKS:
            # Marks within a line hold no blocks, unless they are what an article never has.
            if closing:
                if stack.has(tag):
                    end_block()
                    stack.close(tag)
            elif tag not in _VOID:
                mark = _opened(tag, source, stack.top, start)
                telling = mark.side and not (stack.top and stack.top.side)
                if (telling or mark.doubt) and not source.endswith("/"):
                    end_block()
                    stack.push(mark)
            continue
        end_block()
        if closing:
            stack.close(tag)
        elif tag != "hr":
            stack.make_room(tag)
            stack.push(_opened(tag, source, stack.top, start))
    pieces.append(page[at:])
    end_block()
    return found


_CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}


def _hashed(*parts: str) -> int:
    data = "\0".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=1 << 16)
def _below(around: int, name: str) -> int:
    """The token of an element of that name in the element ``around``."""
    return _hashed("", str(around), name)


def _elements(found: list[Block]) -> list[Element]:
    """The elements around the blocks, in the order they open, so none before the one around it."""
    met: dict[int, Element] = {}
    for block in found:
        element = block.element
        while element and element.number not in met:
            met[element.number] = element
            element = element.around
    return [met[number] for number in sorted(met)]


def tokens(found: list[Block]) -> dict[int, list[int]]:
    """Of each token: how often it occurs, the element around it (0 if none), its characters, and
    whether it is text (0), an element (1), or one that can be a slot (2). An element has all
    characters below it that may be an article's."""
    counted: dict[int, list[int]] = {}
    chars: Counter[int] = Counter()
    for block in found:
        own = 0 if block.side or block.doubtful else len(block.text)
        if block.element:
            chars[block.element.number] += own
        if not block.side:
            entry = counted.setdefault(block.token, [0, block.around, 0, 0])
            entry[0] += 1
            entry[2] += own
    for element in reversed(_elements(found)):
        around = element.around
        slot = 2 if element.tag in _SLOTS else 1
        entry = counted.setdefault(element.token, [0, around.token if around else 0, 0, slot])
        entry[0] += 1
        entry[2] += chars[element.number]
        if around:
            chars[around.number] += chars[element.number]
    return counted


def main_text(page: str | None, template: list[int], slots: dict[int, float] | None) -> str:
    """A page's article.

    All blocks below the slot that holds the article, less what ``template`` has word for word.
    Elements marked as an article are that slot, also if the template has all of their text; without
    such it is found by ``slots``, the characters that pages have in each, on average.
    """
    known = set(template)
    every = blocks(page)
    # What the template confirms not to be part of an article, and all that is in it.
    confirmed: set[int] = set()
    for element in _elements([block for block in every if block.doubtful]):
        inside = element.around is not None and element.around.number in confirmed
        if inside or (element.doubt and element.token in known):
            confirmed.add(element.number)
    found = [b for b in every if not b.side and not (b.doubtful and b.element.number in confirmed)]
    own = [block for block in found if block.token not in known]
    marked = [b for b in own if b.article] or [b for b in found if b.article]
    return "\n".join(block.text for block in marked or _in_slot(own, slots or {}))


def _in_slot(found: list[Block], slots: dict[int, float]) -> list[Block]:
    """The blocks below the innermost slot that holds most of what is in each slot around it."""
    nearest: dict[int, int] = {}  # of an element: the slot it is or is in, 0 if none
    outer: dict[int, int] = {}  # of a slot: the one around it; none before that
    for element in _elements(found):
        slot = nearest.get(element.around.number, 0) if element.around else 0
        if element.token in slots:
            outer.setdefault(element.token, slot)
            slot = element.token
        nearest[element.number] = slot
    home = [nearest[block.element.number] if block.element else 0 for block in found]
    rest: Counter[int] = Counter()
    for block, slot in zip(found, home, strict=True):
        rest[slot] += len(block.text)
    below: dict[int, list[int]] = {}
    for slot, around in outer.items():
        below.setdefault(around, []).append(slot)
    at = 0
    while at in below:
        total = rest[at] + sum(slots[slot] for slot in below[at])
        largest = max(below[at], key=lambda slot: (slots[slot], slot))
        if slots[largest] < MOST * total:
            break
        at = largest
    if not at:
        return found
    inside = {at}
    for slot, around in outer.items():
        if around in inside:
            inside.add(slot)
    return [block for block, slot in zip(found, home, strict=True) if slot in inside]


def _host(url: Column) -> Column:
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def templates(pages: DataFrame) -> DataFrame:
    """Per ``host``: ``template``, the text of its template and the elements that most pages have,
    ``slots`` with the characters that pages have in each, ``sizes``, on average, and the number of
    its different ``pages``. ``pages`` has ``host``, ``page`` (a hash) and ``html``; hosts of few
    pages are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            columns = (batch.column(name) for name in ("host", "page", "html"))
            for host, page, source in zip(*columns, strict=True):
                name, key = host.as_py(), page.as_py()
                for token, (n, around, chars, kind) in tokens(blocks(source.as_py())).items():
                    # A number that stands for this page and this count.
                    rows.append((name, token, hash((key, n)) >> 1, around, chars, kind, int(n == 1)))
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(_ARROW.values())]
            yield pa.RecordBatch.from_arrays(arrays, list(_ARROW))

    schema = "host string, token bigint, cell bigint, around bigint, chars bigint, kind int, once int"
    each = pages.mapInArrow(count, schema)
    # Copies of a page are no evidence of a template: they have equal cells, and count once.
    each = each.groupBy("host", "token", "cell").agg(
        *[F.max(name).alias(name) for name in ("around", "chars", "kind", "once")]
    )
    # The sum over pages stands for the whole vector, in whatever order pages are met.
    seen = each.groupBy("host", "token").agg(
        F.count("*").alias("n"),
        F.sum(F.col("cell").cast("decimal(38,0)")).cast("string").alias("vector"),
        F.max("around").alias("around"),
        F.sum("chars").alias("chars"),
        F.max("kind").alias("kind"),
        F.sum("once").alias("once"),
    )
    size = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    frequent = (
        seen.filter(F.col("n") >= LEAST_PAGES).join(size, "host").filter(F.col("n") >= LAYOUT * F.col("pages"))
    )
    result = "host string, template array<bigint>, slots array<bigint>, sizes array<double>, pages bigint"
    return frequent.groupBy("host").applyInArrow(_template, result)


_ARROW = {
    "host": pa.string(),
    "token": pa.int64(),
    "cell": pa.int64(),
    "around": pa.int64(),
    "chars": pa.int64(),
    "kind": pa.int32(),
    "once": pa.int32(),
}


def _template(table: pa.Table) -> pa.Table:
    """A host's template from the tokens that enough pages have, see :func:`templates`."""
    seen = {row["token"]: row for row in table.to_pylist()}
    classes: dict[tuple, list[int]] = {}
    for token, row in seen.items():
        classes.setdefault((row["n"], row["vector"]), []).append(token)
    chains = _nested(seen, classes)
    template, chars = [], {token: row["chars"] for token, row in seen.items()}
    for token, row in seen.items():
        key = (row["n"], row["vector"])
        around = seen.get(row["around"])
        if row["kind"]:
            if row["n"] >= SHARE * row["pages"]:
                template.append(token)
        elif chains[key] is not None and len(classes[key]) >= LEAST_TOKENS:
            if row["n"] >= SHARE * (around["n"] if around else row["pages"]):
                template.append(token)
                while around:
                    chars[around["token"]] -= row["chars"]
                    around = seen.get(around["around"])
    slots = [
        token
        for token, row in seen.items()
        if row["kind"] == 2 and 2 * row["once"] >= row["n"] and chars[token] > 0
    ]
    sizes = [chars[token] / seen[token]["n"] for token in slots]
    columns = {"template": pa.array([template], pa.list_(pa.int64()))}
    columns["slots"] = pa.array([slots], pa.list_(pa.int64()))
    columns["sizes"] = pa.array([sizes], pa.list_(pa.float64()))
    columns["pages"] = pa.array([table["pages"][0].as_py()], pa.int64())
    return pa.table({"host": pa.array([table["host"][0].as_py()], pa.string()), **columns})


def _nested(seen: dict[int, dict], classes: dict[tuple, list[int]]) -> dict[tuple, list | None]:
    """The classes around each class, from the outermost on; None if they do not lie one within the
    other, or one of them is not nested itself."""
    chains: dict[tuple, list | None] = {}

    def around(key: tuple) -> set[tuple]:
        # Text can stand in an element that the class holds again: elements tell, if there are any.
        members = [token for token in classes[key] if seen[token]["kind"]] or classes[key]
        rows = (seen.get(seen[token]["around"]) for token in members)
        return {(row["n"], row["vector"]) for row in rows if row} - {key}

    open_: list[tuple] = []
    for start in classes:
        open_.append(start)
        while open_:
            key = open_[-1]
            if key in chains:
                open_.pop()
                continue
            left = [k for k in around(key) if k not in chains]
            if any(k in open_ for k in left):
                chains[key] = None  # each within the other
            elif left:
                open_ += left
                continue
            else:
                outer = sorted(((chains[k], k) for k in around(key)), key=lambda c: len(c[0] or ()))
                chain: list | None = []
                for up, k in outer:
                    fits = up is not None and chain is not None and up[: len(chain)] == chain
                    chain = [*up, k] if fits else None
                chains[key] = chain
            open_.pop()
    return chains


def extract_text(
    pages: DataFrame, *, url: str = "url", source: str = "html", text: str = "text"
) -> DataFrame:
    """Add ``text``, the main text of each page, and ``n_chars``, its code points.

    Character references are decoded, white space within a block is one space, blocks are joined by
    line ends. Text is empty for a null or empty page, or one without an article. Pages without a
    host, or alone on theirs, are judged by their own elements. Repeated pages give equal texts,
    each for itself. Very long pages, markup that never ends and deep nesting take time linear in
    their length. Columns of these names are replaced; all others stay. An empty table gives no rows.
    """
    given = [name for name in pages.columns if name not in (text, "n_chars")]
    rows = pages.select(
        F.struct(*[column(name).alias(f"c{k}") for k, name in enumerate(given)]).alias("row"),
        _host(column(url)).alias("host"),
        F.coalesce(column(source), F.lit("")).alias("html"),
    )
    pages_ = rows.filter("host <> ''").select("host", F.xxhash64("html").alias("page"), "html")
    joined = _beside(rows, stored(templates(pages_), "templates"))

    def extract(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = []
            for page, *known_ in zip(*batch, strict=True):
                template, slots, sizes = (value.as_py() or [] for value in known_)
                texts.append(main_text(page.as_py(), template, dict(zip(slots, sizes, strict=True))))
            yield pa.array(texts, pa.string())

    found = F.arrow_udf(extract, "string")("html", "template", "slots", "sizes")
    back = [F.col(f"row.c{k}").alias(name) for k, name in enumerate(given)]
    out = joined.select(*back, found.alias(text))
    return out.withColumn("n_chars", F.length(column(text)).cast("bigint"))


def _beside(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows, each with the template of its host, if there is one."""
    size = (F.size("template") + 2 * F.size("slots") + F.lit(8)) * 8 + F.octet_length("host")
    sized = known.select("host", "pages", size.cast("bigint").alias("bytes"))
    known = known.drop("pages")
    if (sized.agg(F.sum("bytes")).head()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(known), "host", "left")
    largest = sized.orderBy(F.desc("pages"), "host").limit(HOT_HOSTS).collect()
    upto = accumulate(row.bytes for row in largest)
    hot = [row.host for row, sum_ in zip(largest, upto, strict=True) if sum_ <= BROADCAST_BYTES]
    # Pages without a host have no template to meet.
    is_hot = F.col("host").isin(["", *hot])
    often = rows.filter(is_hot).join(F.broadcast(known.filter(is_hot)), "host", "left")
    return often.unionByName(rows.filter(~is_hot).join(known.filter(~is_hot), "host", "left"))
