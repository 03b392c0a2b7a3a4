"""Main text of web pages by the template that pages of a host share.

Pages of one host are taken in groups of bounded size. Within a group, tokens (tags in their place
among the structural elements, and whole text blocks) that occur equally often in each page form an
equivalence class. A class is valid if its tokens keep one order in every page, and if each of its
occurrences lies in one slot of the class around it. The class of tokens that occur once in every page is
the template's frame, valid classes inside its slots are nested in it, and what remains between the
frame's tokens are its slots. Text of the frame, and text that comes with each occurrence of a nested
element, is left out on all pages, within an article too, unless it is most of what the articles (or
the element) hold: then they are copies. Slots whose enclosing elements are menus,
notices and the like are left out. An article (or main) element is evidence for the main slot: it is the
text unless far more words stand in other slots. Elsewhere all slots of the page are, but for blocks that
are nothing but several links, lists that are mostly links and, outside the template's largest slot, blocks that are mostly links and
text that is on all pages but for one number in it.
A name that an article's own section may have (legal, related) counts only where little prose is
under it. A page without company has only its own elements.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm import urls
from cellstar.llm.shared import staged

#: Pages of a host that are compared with each other, and how many must share a class.
GROUP, SUPPORT = 48, 3
#: How many times the words of an article count against those of other slots.
EVIDENCE = 4
#: Words outside links from which a doubtful element of an article is prose.
PROSE = 20
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
STRUCTURE = frozenset(
    "html head body nav header footer main article section aside div form fieldset ul ol dl table menu dialog figure "
    "details template title select button textarea label iframe object canvas audio video".split()
)
LISTS = frozenset("ul ol dl menu".split())
#: Elements that never hold the article's own words.
BOILERPLATE = frozenset(
    "head nav footer aside form menu dialog template title select button textarea label iframe object canvas audio "
    "video noscript svg math".split()
)
_ROLE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|"
    r"gdpr|hidden|legal|login|masthead|menu|modal|nav|navbar|navigation|navigation-bar|newsletter|notice|notices|notification|"
    r"pagination|pager|popup|promo|promoted|related|replies|respond|search|share|sharing|sidebar|signup|site-header|social|sponsor|"
    r"sponsored|subscribe|subscription|tags|toolbar|widgets?|alert|alertdialog|complementary|contentinfo)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Parts of the names above that an article's own sections may have.
_DOUBTFUL = re.compile(
    r"(?:^|(?<=[\s_-]))(?:alert|banner|legal|notices?|notification|promo|promoted|related|search|share|sharing|social|sponsor|sponsored|"
    r"subscription|tags|toolbar|widgets?|complementary)(?=$|[\s_-])",
    re.IGNORECASE,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|svg|math|template|textarea)\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)


class Paths:
    """Structural elements by number, each with its parent: equal paths of labels have one number. 0 is the page."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, str], int] = {}
        self.parent, self.name, self.within = [0], [""], [False]

    def child(self, parent: int, name: str, label: str) -> int:
        number = self.known.setdefault((parent, label), len(self.parent))
        if number == len(self.parent):
            self.parent.append(parent)
            self.name.append(name)
            # Whether it stands in an article.
            self.within.append(self.within[parent] or self.name[parent] in ("article", "main"))
        return number

    def slots(self, tags: set[tuple[int, str]]) -> list[int]:
        """Of each path its innermost element up to which all are among the tags (all elements if there are none)."""
        slots, whole = [0], [True]
        for path in range(1, len(self.parent)):  # parents have smaller numbers
            above = self.parent[path]
            whole.append(whole[above] and (not tags or (path, self.name[path]) in tags))
            slots.append(path if whole[path] else slots[above])
        return slots


@dataclass
class Block:
    """A run of text between block-level tags."""

    text: str
    link_words: int
    only_links: bool  # several links and no word beside them
    path: int
    unwanted: bool
    article: bool
    doubt: int  # the doubtful element of an article around it, 0 for none
    list: int  # the list it stands in, 0 for none


def _unwanted(name: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """(whether an element is left out, whether only if it holds no prose)."""
    if name in BOILERPLATE or name == "header" and not in_article:
        return True, False
    if not attrs or name in ("html", "body", "article", "main"):
        return False, False
    doubt = False
    for key, *values in _ATTRIBUTE.findall(attrs):
        value = next(filter(None, values), "")
        if key.lower() == "hidden" or key.lower() == "aria-hidden" and value.lower() == "true":
            return True, False
        if _ROLE.search(value):
            if not in_article or _ROLE.search(_DOUBTFUL.sub("", value)):
                return True, False
            doubt = True
    return False, doubt


def parse(page: str, paths: Paths) -> tuple[list[tuple], list[Block]]:
    """(tokens, blocks) of a page. A token is a block-level tag or a block's text, with its structural path."""
    tokens: list[tuple] = []
    blocks: list[Block] = []
    # Open structural elements: name, path, whether it or one around it is left out, whether within an article, doubtful element, list.
    stack: list[tuple[str, int, bool, bool, int, int]] = [("", 0, False, False, 0, 0)]
    names: Counter = Counter()
    words: list[str] = []
    outside: list[str] = []
    links, link_words, in_link = 0, 0, False

    def flush() -> None:
        nonlocal links, link_words
        text = " ".join(html.unescape("".join(words)).split()) if words else ""
        words.clear()
        if text:
            only_links = links > 1 and not any(c.isalnum() for c in html.unescape("".join(outside)))
            blocks.append(Block(text, link_words, only_links, *stack[-1][1:]))
            tokens.append((stack[-1][1], text))
        outside.clear()
        links = link_words = 0

    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            words.append(m["text"])
            if in_link:
                link_words += len(m["text"].split())
            else:
                outside.append(m["text"])
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"] or m["close2"])
        if name in INLINE:
            if name == "a":
                in_link = not closing
                links += in_link
            elif name == "br":
                words.append(" ")
            continue
        flush()
        in_link = False
        if name in STRUCTURE:
            if closing and names[name]:
                last = ""
                while last != name:
                    last = stack.pop()[0]
                    names[last] -= 1
            attrs = m["attrs"] or ""
            if not closing and not attrs.endswith("/"):
                values = " ".join(sorted("".join(a[1:]) for a in _ATTRIBUTE.findall(attrs)))
                label = f"{name} {re.sub(r'[0-9]+', '9', values)}".rstrip()
                left_out, doubtful = _unwanted(name, attrs, names["article"] + names["main"] > 0)
                _, path, around, article, doubt, listed = stack[-1]
                article = article or name in ("article", "main") or 'role="main"' in attrs
                doubt = doubt or doubtful and len(tokens) + 1 or 0
                listed = len(tokens) + 1 if name in LISTS else listed
                stack.append((name, paths.child(path, name, label), around or left_out, article, doubt, listed))
                names[name] += 1
            tokens.append((stack[-1][1], ("/" if closing else "") + name))
        elif name not in VOID:
            tokens.append((stack[-1][1], ("/" if closing else "") + name))
    flush()
    return tokens, blocks


def _ordered(members: set, tokens: list[list[tuple]], counts: dict[int, int]) -> list | None:
    """The class's tokens in the order they keep in every page, each occurrence of the class anew; else None."""
    order: list | None = None
    for page, times in counts.items():
        seen = [t for t in tokens[page] if t in members]
        first = seen[: len(members)]
        if order is None:
            order = first
        if len(set(first)) != len(members) or seen != order * times:
            return None
    return order


def deduce(tokens: list[list[tuple]]) -> tuple[list, set]:
    """(frame, nested): the frame's tokens in order, and the tokens of valid classes nested in its slots."""
    vectors: dict[tuple, dict[int, int]] = defaultdict(dict)
    for page, own in enumerate(tokens):
        for token, n in Counter(own).items():
            vectors[token][page] = n
    classes: dict[tuple, set] = defaultdict(set)
    for token, vector in vectors.items():
        if len(vector) >= SUPPORT:
            classes[tuple(vector.items())].add(token)
    whole = tuple((page, 1) for page in range(len(tokens)))
    members = classes.pop(whole, set())
    frame = _ordered(members, tokens, dict(whole)) if members else []
    if frame is None:  # keep what never changes its place: the tokens in an order common to all pages
        frame = _common_order(members, tokens)
    inside, nested = set(frame), set()
    for vector, group in classes.items():
        counts = dict(vector)
        order = _ordered(group, tokens, counts)
        if order is None:
            continue
        slots = set()
        for page in counts:
            slot = 0
            for t in tokens[page]:
                if t in inside:
                    slot += 1
                elif t in group:
                    slots.add(slot)
        if len(slots) == 1:
            nested |= group
    return frame, nested


def _common_order(members: set, tokens: list[list[tuple]]) -> list:
    order = [t for t in tokens[0] if t in members]
    for own in tokens[1:]:
        place = {t: i for i, t in enumerate(t for t in own if t in members)}
        kept: list = []
        for t in order:  # greedy: tokens that stand before one already kept are left out
            if not kept or place[t] > place[kept[-1]]:
                kept.append(t)
        order = kept
    return order


def clusters(parsed: list[tuple[list[tuple], list[Block]]], paths: Paths) -> list[list[int]]:
    """Pages by template: those that share at least half of their structural elements outside articles with the first."""
    out: list[tuple[set, list[int]]] = []
    for page, (tokens, _) in enumerate(parsed):
        own = {path for path, t in tokens if t in STRUCTURE and not paths.within[path]}
        for elements, members in out:
            if 2 * len(own & elements) >= len(own | elements):
                members.append(page)
                break
        else:
            out.append((own, [page]))
    return [members for _, members in out]


def _prose(blocks: list[Block]) -> list[Block]:
    """Blocks not left out, those of a doubtful element only if it holds prose."""
    words: Counter = Counter()
    links: Counter = Counter()
    for b in blocks:
        words[b.doubt] += len(b.text.split())
        links[b.doubt] += b.link_words
    good = {d for d in words if not d or words[d] - links[d] >= PROSE and 2 * links[d] <= words[d]}
    return [b for b in blocks if not b.unwanted and b.doubt in good]


def extract(pages: list[str]) -> list[str]:
    """Main text of pages of one host, blocks joined by an empty line."""
    paths = Paths()
    parsed = [parse(p, paths) for p in pages]
    out = [""] * len(pages)
    for members in clusters(parsed, paths):
        for page, text in zip(members, _texts([parsed[m] for m in members], paths), strict=True):
            out[page] = text
    return out


def _texts(parsed: list[tuple[list[tuple], list[Block]]], paths: Paths) -> list[str]:
    """Main text of pages of one template."""
    distinct = list({tuple(t): t for t, _ in parsed}.values())
    frame, nested = deduce(distinct) if len(distinct) >= SUPPORT else ([], set())
    fixed = set(frame)
    tags = {t for t in nested if t[1].removeprefix("/") in STRUCTURE} | fixed
    wanted = [_prose(blocks) for _, blocks in parsed]
    fixed |= _nested_text(wanted, nested, distinct, paths)
    # Articles that are mostly text of the template are copies of each other, and theirs stays.
    own, shared = (
        sum(len(b.text.split()) for blocks in wanted for b in blocks if b.article and ((b.path, b.text) in fixed) == of_frame)
        for of_frame in (False, True)
    )
    copies = shared >= own
    mass: Counter = Counter()
    pages_with: dict[tuple, set] = defaultdict(set)
    # A slot is known by the template's elements around it; others are part of what is in the slot.
    slot_of = paths.slots(tags)
    kept = []
    for page, blocks in enumerate(wanted):
        slots = []
        for b in blocks:
            if (b.path, b.text) in fixed and not (b.article and copies):
                continue
            slot = slot_of[b.path]
            mass[slot] += len(b.text.split()) - b.link_words
            pages_with[slot, _numbered(b.text)].add(page)
            slots.append((slot, b))
        kept.append(slots)
    main = max((s for s in mass if mass[s] > 0), key=lambda s: (mass[s], -s), default=None)
    out = []
    for slots in kept:
        inside = [b for _, b in slots if b.article]
        beside = [
            b for slot, b in slots
            if not b.article and not b.only_links and (slot == main or b.list or 2 * b.link_words <= len(b.text.split()))
            and (not frame or slot == main or len(pages_with[slot, _numbered(b.text)]) < len(parsed))
        ]
        menus = _menus(beside)
        beside = [b for b in beside if b.list not in menus]
        words = sum(len(b.text.split()) for b in inside), sum(len(b.text.split()) for b in beside)
        alone = inside and EVIDENCE * words[0] >= words[1]
        chosen = {id(b) for b in (inside if alone else inside + beside)}
        out.append("\n\n".join(b.text for _, b in slots if id(b) in chosen))
    return out


def _nested_text(wanted: list[list[Block]], nested: set, tokens: list[list[tuple]], paths: Paths) -> set:
    """Texts that come with each occurrence of a nested element, where other text is most of what it holds."""
    counts: dict[tuple, dict[int, int]] = defaultdict(dict)
    for page, own in enumerate(tokens):
        for t, n in Counter(t for t in own if t in nested).items():
            counts[t][page] = n
    same = {(b.path, b.text) for blocks in wanted for b in blocks if b.path and (b.path, b.text) in nested}
    same = {t for t in same if counts[t] == counts.get((t[0], paths.name[t[0]]))}
    free: Counter = Counter()
    for blocks in wanted:
        for b in blocks:
            free[b.path] += len(b.text.split()) * (-1 if (b.path, b.text) in same else 1)
    return {t for t in same if free[t[0]] > 0}


def _menus(blocks: list[Block]) -> set[int]:
    """The lists that are mostly links."""
    surplus: Counter = Counter()
    for b in blocks:
        surplus[b.list] += 2 * b.link_words - len(b.text.split())
    return {element for element, n in surplus.items() if element and n > 0}


def _numbered(text: str) -> str:
    """The text without its number if it has just one and words beside it."""
    parts = re.split(r"[0-9]+", text)
    return "9".join(parts) if len(parts) == 2 and any(c.isalpha() for c in text) else text


def main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) of every page; a null html is empty, and so is a page without an article.

    A host's pages are spread over groups of about ``GROUP`` by a hash of page and content, so that a large host
    is many groups. Pages without a host form groups of their own. Repeated rows stay.
    """
    cells = [F.col(f"`{c}`").alias(n) for c, n in ((id_column, "id"), (url_column, "url"), (html_column, "html"))]
    rows = pages.select(*cells).withColumn("host", urls.host(F.col("url")))
    # Written, so that Spark knows its size before it plans the join, and need not shuffle the pages for it
    # where the hosts are few enough to ship.
    sizes = staged(rows.groupBy("host").agg(F.ceil(F.count("*") / GROUP).alias("parts")))
    salt = F.xxhash64("id", "url", "html")
    # One column names the group: were it (host, part), rows dealt by host for the join would stay as they are,
    # with all of a large host in one task.
    group = F.concat_ws("\n", "host", F.pmod(salt, F.col("parts")))
    dealt = rows.join(sizes, "host").select("id", "url", "html", group.alias("group"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        contents = [h or "" for h in group.column("html").to_pylist()]
        # In an order of their own, so that reruns agree.
        order = sorted(range(len(contents)), key=contents.__getitem__)
        texts = [""] * len(contents)
        for page, text in zip(order, extract([contents[k] for k in order]), strict=True):
            texts[page] = text
        return pa.table({
            "id": group.column("id"), "url": group.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array(map(len, texts), pa.int64()),
        })

    return dealt.groupBy("group").applyInArrow(run, f"id {kind}, url string, text string, n_chars bigint")
