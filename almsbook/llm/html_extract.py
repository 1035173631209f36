"""Main text of web pages by scoring their element tree.

Each page becomes a tree. What is never part of an article goes first: scripts, styles, forms, navigation, footers,
asides and elements whose class, id or role says menu, advert, notice, sidebar or reader comments. Every block of
text that remains is a paragraph worth points for its length and its commas, less the share of its letters that are
link text. A paragraph passes its points to the elements around it, in full to the parent, half to the next, a third to
the one after and so on. An element's score is what it was passed, again less its share of link text. The element with
the highest score is the container; if it lies in an ``article``, the container is the outermost such article, so that
none of its sections is lost, and the same holds for ``main`` where there is no article. Siblings of the container are
kept where they score a fifth of it or more, look like it by tag and class, are headings directly before it, or are long
or finished sentences nearly without links.

Blocks of the kept elements, in page order, are joined by one space; white space (as Unicode has it) inside a block
becomes one space. Inside the kept elements only lists and boxes that are nearly all links are left out. Nothing is
cut off, whatever the length.

Reading is tolerant: unclosed paragraphs, items and cells end where the next begins, end tags
without a start and stray angle brackets are harmless, an unclosed comment or script runs to the end of the page. The
time follows the length of the page times the depth of its nesting, which ends at 512.

Work is per page, in Arrow batches inside the tasks; nothing is shuffled or sent to the driver.

Defined results: a null or empty page, or one without article text, has an empty text and 0 characters; repeated rows
and repeated ids have a row each; a null id or url stays null; of equally good containers the innermost wins, of those
the first; an empty table gives no rows; other columns are not looked at.
"""

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How HTML elements behave.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small source span "
    "strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# A start tag of the key ends the nearest open element of the value, unless one of the fences lies between; so does an end tag.
IMPLIED_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "tr": {"tr"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody"}, "tfoot": {"thead", "tbody"}, "a": {"a"},
}
FENCES = {
    "li": {"ul", "ol", "menu", "dir", "table", "td", "th"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "optgroup": {"select"},
    "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}, "thead": {"table"},
    "a": {"table", "td", "th", "li", "article", "main"},
}
PARAGRAPH_FENCES = {"td", "th", "table", "caption", "button", "object", "li", "dd", "dt", "div", "section", "article", "main", "body"}

# Elements and roles that hold no article text.
FURNITURE = frozenset(
    "nav footer aside form menu dialog search button select datalist fieldset script style template noscript textarea title iframe xmp noembed "
    "noframes svg canvas object audio video map".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# Words of classes and ids. Boxes named so go; those of the second list only unless they are also named like text.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion outbrain taboola".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
NEVER_TEXT = ADVERTS | COMMENTS | frozenset(
    "sidebar skyscraper nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar share sharing social footer "
    "related recommended recommendations recirculation cookie cookies consent gdpr newsletter subscribe subscription signup login popup modal overlay "
    "paywall".split()
)
SELDOM_TEXT = frozenset("header masthead banner notice notices alert alerts widget widgets rail aside search form hidden".split())
NAMED_LIKE_TEXT = frozenset("article body content entry main post story text".split())
# Words after one of these say what an element has or is filed under, not what it is: "has-sidebar", "category-menu".
ABOUT = frozenset("has with no without hide show category tag".split())
# Headings over boxes that are no part of the article.
BOX_HEADINGS = frozenset((
    "comments", "comment", "reader comments", "readers comments", "leave a comment", "leave a reply", "post a comment", "add a comment",
    "related articles", "related posts", "related stories", "you may also like", "you might also like", "advertisement", "share this",
))

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Their text counts for the element around them, and they are no containers.
PARAGRAPHS = HEADINGS | frozenset("p li dt dd blockquote pre figcaption address summary".split())
PARTS = PARAGRAPHS | INLINE | frozenset("ul ol dl table thead tbody tfoot tr figure details".split())
SENTENCE_END = (".", "!", "?", "…", "。")
MENU_SHARE = 0.8
SIBLING_SHARE = 0.2
# Elements nested deeper become siblings, as in browsers; their text stays.
DEEPEST = 512

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s=>/][^\s=>/]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+|=)""")
_NAME_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_KEPT_ATTRIBUTES = frozenset(("class", "id", "role", "hidden", "aria-hidden", "style"))


class Node:
    """An element: its tag, the attributes that matter, and children that are nodes or strings."""

    __slots__ = ("tag", "attributes", "parent", "children", "letters", "linked", "passed", "articles", "depth")

    def __init__(self, tag: str, attributes: dict[str, str], parent: "Node | None") -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.letters = self.linked = self.articles = 0
        self.passed = 0.0
        self.depth = 0 if parent is None else parent.depth + 1


def parse(html: str) -> Node:
    """The element tree of a page; an end tag ends the nearest open element of its name."""
    root = at = Node("body", {}, None)
    open_tags: dict[str, int] = {}
    place, size = 0, len(html)

    def close(node: Node) -> None:
        """End all open elements up to and with ``node``."""
        nonlocal at
        while True:
            done, at = at, at.parent
            open_tags[done.tag] -= 1
            if done is node:
                return

    def nearest(tags: set[str], fences: set[str]) -> Node | None:
        """The nearest open element of ``tags`` before a fence."""
        if not any(open_tags.get(t) for t in tags):
            return None
        node = at
        while node is not root and node.tag not in tags:
            if node.tag in fences:
                return None
            node = node.parent
        return None if node is root else node

    while place < size:
        start = html.find("<", place)
        if start < 0:
            start = size
        if start > place:
            at.children.append(unescape(html[place:start]))
        if start == size:
            break
        if html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            place = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            place = size if end < 0 else end + 1
            continue
        tag = _TAG.match(html, start)
        if not tag:
            at.children.append("<")
            place = start + 1
            continue
        name, place, attributes = tag[1].lower(), tag.end(), {}
        if html.startswith(">", place):
            own_end, place = False, place + 1
        else:
            while found := _ATTRIBUTE.match(html, place):
                place = found.end()
                if found[1] and (key := found[1].lower()) in _KEPT_ATTRIBUTES and key not in attributes:
                    attributes[key] = unescape((found[2] or "").strip("\"'"))
            end = html.find(">", place)
            own_end = html[place:end].strip() == "/" if end >= 0 else False
            place = size if end < 0 else end + 1
        if html[start + 1] == "/":
            if open_tags.get(name):
                node, fences = at, FENCES.get(name, ())
                while node.tag != name and node.tag not in fences and not (name in INLINE and name != "a" and node.tag not in INLINE):
                    node = node.parent
                if node.tag == name:
                    close(node)
            elif name == "br":
                at.children.append(Node("br", {}, at))
            continue
        if name in ("html", "head", "body"):
            continue
        if name in ENDS_PARAGRAPH and (node := nearest({"p"}, PARAGRAPH_FENCES)):
            close(node)
        if name in IMPLIED_ENDS and (node := nearest(IMPLIED_ENDS[name], FENCES[name])):
            close(node)
        node = Node(name, attributes, at)
        at.children.append(node)
        if name in RAW_TEXT:
            end = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, place)
            place = size if not end else end.start()
            if end:
                end_of_tag = html.find(">", place)
                place = size if end_of_tag < 0 else end_of_tag + 1
        elif name not in VOID and node.depth < DEEPEST and not (own_end and (name == "svg" or open_tags.get("svg"))):
            at = node
            open_tags[name] = open_tags.get(name, 0) + 1
    return root


def names_of(node: Node) -> set[str]:
    """Lower-case words of class and id, pairs of them joined too, without what follows words like "has"."""
    words: set[str] = set()
    for name in f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}".split():
        before = ""
        for word in _NAME_WORD.findall(name):
            word = word.lower()
            if word in ABOUT:
                break
            words |= {word, before + word}
            before = word
    return words


def walk(root: Node) -> Iterator[Node]:
    """All elements in page order, parents first; without recursion, since pages can nest without end."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(child for child in reversed(node.children) if not isinstance(child, str))


def heading_of(node: Node) -> str:
    """The words of the heading a box begins with."""
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                return ""
        elif child.tag in HEADINGS:
            text = "".join(c for n in walk(child) for c in n.children if isinstance(c, str))
            return " ".join(re.sub(r"[^\w\s]|\d", " ", text).lower().split())
        elif child.tag not in VOID:
            return ""
    return ""


def is_article(node: Node) -> bool:
    return node.tag in ("article", "main") and not names_of(node) & (ADVERTS | COMMENTS)


def is_furniture(node: Node, in_article: bool, articles: int) -> bool:
    """True if the element is no part of an article by its tag, role, name or heading.

    A box around all ``articles`` of the page is none, whatever its name.
    """
    attributes = node.attributes
    if articles and node.articles == articles:
        return False
    if node.tag in FURNITURE:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "style" in attributes and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes["style"].lower()):
        return True
    if is_article(node):
        return False
    if node.tag == "header":
        return not (in_article and any(n.tag in HEADINGS for n in walk(node)))
    if attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    if node.tag in HEADINGS or not attributes and node.tag in PARAGRAPHS:
        return False
    names = names_of(node)
    if node.tag in INLINE:
        # Code is marked up with classes like "comment".
        return bool(names & ADVERTS)
    if names & NEVER_TEXT or names & SELDOM_TEXT and not names & NAMED_LIKE_TEXT:
        return True
    return heading_of(node) in BOX_HEADINGS


def prune(root: Node) -> None:
    """Take all furniture out of the tree."""
    for node in reversed(list(walk(root))):
        node.articles += is_article(node)
        if node.parent is not None:
            node.parent.articles += node.articles
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        node.children = [c for c in node.children if isinstance(c, str) or not is_furniture(c, inside, root.articles)]
        stack.extend((c, inside) for c in node.children if not isinstance(c, str))


def blocks(root: Node) -> Iterator[tuple[Node, str, int, int]]:
    """``(element, text, letters, letters in links)`` of every run of text between block borders, in page order."""
    parts: list[str] = []
    linked = 0
    holder = root
    # A None closes the element beside it.
    stack: list[tuple[Node, Node | str | None, int]] = [(root, None, 0)] + [(root, c, 0) for c in reversed(root.children)]
    while stack:
        parent, item, links = stack.pop()
        if isinstance(item, str):
            if not parts:
                holder = parent
            parts.append(item)
            if links:
                linked += len("".join(item.split()))
            continue
        border = item is None or item.tag not in INLINE
        if item is not None and item.tag == "br":
            parts.append(" ")
            continue
        if border:
            if text := " ".join("".join(parts).split()):
                yield holder, text, len(text) - text.count(" "), linked
            parts, linked = [], 0
        if item is not None:
            inner = links + (item.tag == "a")
            if border:
                stack.append((item, None, links))
            stack.extend((item, c, inner) for c in reversed(item.children))


def points(text: str) -> float:
    """A paragraph's worth: one for 25 letters, up to three for length, one for every comma."""
    commas = sum(text.count(c) for c in ",،、，")
    return min(1.0, len(text) / 25) + min(3.0, len(text) / 100) + commas


def block_element(node: Node) -> Node:
    while node.tag in INLINE and node.parent is not None:
        node = node.parent
    return node


def score(root: Node) -> None:
    """Pass the points of every paragraph up and count letters and link letters of every element."""
    for holder, text, letters, linked in blocks(root):
        node = paragraph = block_element(holder)
        worth = points(text) * (1 - min(1.0, linked / max(1, letters)))
        node.letters += letters
        node.linked += linked
        # Text of its own in a box makes the box both the paragraph and its parent.
        node = paragraph if paragraph.tag not in PARAGRAPHS or paragraph.parent is None else paragraph.parent
        share = 1
        while node is not None:
            node.passed += worth / share
            node, share = node.parent, share + 1
    for node in reversed(list(walk(root))):
        if node.parent is not None:
            node.parent.letters += node.letters
            node.parent.linked += node.linked


def density(node: Node) -> float:
    return min(1.0, node.linked / node.letters) if node.letters else 0.0


def final(node: Node) -> float:
    return node.passed * (1 - density(node))


def container(root: Node) -> Node | None:
    """The element with the highest score, or the article around it."""
    best, most = None, 0.0
    for node in walk(root):
        own = final(node)
        if own > most or own == most and best is not None and node.depth > best.depth:
            best, most = node, own
    if best is None:
        return None
    while best.tag in PARTS and best.parent is not None:
        best = best.parent
    around, article, main = best, None, None
    while around is not None:
        if around.tag == "article":
            article = around
        if around.tag == "main" or around.attributes.get("role", "").lower() == "main":
            main = around
        around = around.parent
    return article or main or best


def kept_siblings(best: Node) -> list[Node | str]:
    """The container with those neighbours that look like part of the article."""
    if best.parent is None or best.tag in ("article", "main"):
        return [best]
    around = best.parent.children
    place = next(i for i, c in enumerate(around) if c is best)
    least = max(SIBLING_SHARE * final(best), 1.0)
    out: list[Node | str] = []
    for i, sibling in enumerate(around):
        if sibling is best:
            out.append(sibling)
        elif isinstance(sibling, str):
            text = sibling.strip()
            if len(text) > 80 or text.endswith(SENTENCE_END):
                out.append(sibling)
        elif sibling.tag in HEADINGS:
            if all(isinstance(c, str) and not c.strip() or not isinstance(c, str) and (c.tag in HEADINGS or not c.letters) for c in around[i + 1 : place]):
                out.append(sibling)
        elif final(sibling) >= least or final(sibling) > 0 and sibling.tag == best.tag and names_of(sibling) == names_of(best) and density(sibling) < 0.5:
            out.append(sibling)
        elif sibling.tag == "p":
            text = " ".join(t for _, t, _, _ in blocks(sibling))
            if len(text) > 80 and density(sibling) < 0.25 or density(sibling) == 0 and text.endswith(SENTENCE_END):
                out.append(sibling)
    return out


def without_link_boxes(kept: list[Node | str]) -> None:
    """Take out lists and boxes inside the kept elements that are nearly all links: menus without a name."""
    stack = [node for node in kept if not isinstance(node, str)]
    while stack:
        node = stack.pop()

        def all_links(child: Node | str) -> bool:
            if isinstance(child, str) or child.tag not in ("ul", "ol", "div", "section", "table", "dl") or density(child) <= MENU_SHARE:
                return False
            return sum(n.tag == "a" for n in walk(child)) > 1

        node.children = [c for c in node.children if not all_links(c)]
        stack.extend(c for c in node.children if not isinstance(c, str))


def main_text(html: str | None) -> str:
    """The article of a page as one line of text."""
    if not html:
        return ""
    root = parse(html)
    prune(root)
    score(root)
    best = container(root)
    if best is None:
        return ""
    kept = Node("body", {}, None)
    kept.children = kept_siblings(best)
    without_link_boxes(kept.children)
    return " ".join(text for _, text, _, _ in blocks(kept))


EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
EVERY_CHARS = 8_000_000


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages_of = batch.column("page_id"), batch.column("url"), batch.column("html")
            texts: list[str] = []
            first, held = 0, 0
            for i in range(batch.num_rows):
                # A reference can name a surrogate's half only as a replacement, so every text can be written.
                texts.append(main_text(pages_of[i].as_py()))
                held += len(texts[-1])
                if held >= EVERY_CHARS or i == batch.num_rows - 1:
                    columns = [ids[first : i + 1], urls[first : i + 1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema=EXTRACTED)
                    texts, first, held = [], i + 1, 0

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")
