"""Main text of web pages: a template is deduced per host, and its remaining slots are read."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Container, Iterator, Mapping
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitscope.storage import written

# Elements whose content is no main text, wherever they stand.
ASIDE_ELEMENTS = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video map "
    "nav header footer aside menu form button select textarea input label fieldset dialog".split()
)
# Whole names in a class, id or role of what is beside the text wherever it stands ...
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising ad-banner ad-slot ad-unit ad-container adsbygoogle "
    "sponsor sponsored promo nav navbar nav-bar main-nav navigation breadcrumb breadcrumbs "
    "comment comments comment-list comments-list comment-section comments-section comment-form "
    "user-comments reader-comments reply replies disqus disqus_thread cookie cookies cookie-banner "
    "cookie-notice cookie-consent consent gdpr popup modal newsletter newsletter-signup".split()
)
# ... of what is, unless it holds the text of the page ...
OUTER_NAMES = frozenset(
    "menu sidebar side-bar aside share sharing share-buttons social-share related related-posts "
    "related-articles related-links recommended subscribe signup login search search-box complementary".split()
)
# ... and of what is, besides, only outside of an article.
FRAME_NAMES = frozenset(
    "banner header site-header page-header footer site-footer page-footer notice notices alert social "
    "contentinfo".split()
)
MAIN_ELEMENTS = frozenset(["article", "main"])
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr !doctype".split()
)
RAW_ELEMENTS = frozenset("script style textarea title noscript iframe".split())
INLINE_ELEMENTS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)

LEAST_SHARE = 0.01
LEAST_TEXT_PAGES = 3
LINKED = 0.8
LEAST_OF_TEXT = 0.5  # of the varying text, to be the slot of the article
MOST = 2**60

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z!][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
MARK = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
MARKS = re.compile(r"(?:class|id|role)=[^=]*(?= (?:class|id|role)=|$)")
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)"


def events(page: str) -> Iterator[tuple[str, str]]:
    """("text", content), ("open", label) and ("close", name) in page order.

    A label is the element's name with its class, id and role. The content of scripts and the like
    is text up to their own closing tag, whatever it holds.
    """
    at, end = 0, len(page)
    while at < end:
        match = TAG.search(page, at)
        if match is None:
            break
        if match.start() > at:
            yield "text", page[at : match.start()]
        at = match.end()
        if match.group(2) is None:
            continue
        name = match.group(2).lower()
        if match.group(1):
            yield "close", name
            continue
        rest = match.group(3)
        marks = [f"{k.lower()}={v.strip(chr(34) + chr(39)).lower()}" for k, v in MARK.findall(rest)]
        yield "open", " ".join([name, *sorted(marks)])
        if name in RAW_ELEMENTS:
            stop = re.compile(f"</{name}\\s*>", re.I).search(page, at)
            upto = stop.start() if stop else end
            if upto > at:
                yield "text", page[at:upto]
            at = upto
    if at < end:
        tail = page[at:end]
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", tail)  # a tag that the end of the page cuts off
        tail = tail[: cut.start()] if cut else tail
        if tail:
            yield "text", tail


def closed_by(stack: list[str], name: str) -> int:
    """How much of the stack stays when an element opens: a block ends an open paragraph."""
    if name in INLINE_ELEMENTS or name in VOID_ELEMENTS:
        return len(stack)
    depth = len(stack)
    while depth and stack[depth - 1].split(" ", 1)[0] in INLINE_ELEMENTS:
        depth -= 1
    return depth - 1 if depth and stack[depth - 1].split(" ", 1)[0] == "p" else len(stack)


def closes(stack: list[str], name: str) -> int:
    """The place of the innermost open element of that name, or -1."""
    depth = len(stack) - 1
    while depth >= 0 and stack[depth].split(" ", 1)[0] != name:
        depth -= 1
    return depth


FRAME, OUTER, ASIDE = 1, 2, 3


@lru_cache(maxsize=1 << 16)
def rank(label: str) -> int:
    """Which of the lists of names the class, id or role of an element stands in, if any."""
    names = {name for mark in MARKS.findall(label) for name in mark.partition("=")[2].split()}
    for found, listed in ((ASIDE, ASIDE_NAMES), (OUTER, OUTER_NAMES), (FRAME, FRAME_NAMES)):
        if names & listed:
            return found
    return 0


class Element:
    """An open element: its path, whether the template has it, what its text is, and that text."""

    __slots__ = (
        *("label", "name", "path", "anchored", "parent", "rank", "level", "aside", "main", "beside"),
        *("seen", "constant", "start", "kept", "free", "text"),
    )

    def __init__(self, label: str, path: str, anchored: bool, parent: Element | None):
        self.label, self.name = label, label.partition(" ")[0]
        self.path, self.anchored, self.parent = path, anchored, parent
        above = parent is not None
        self.rank = rank(label) if " " in label else 0
        self.level = max(self.rank, parent.level) if above else self.rank
        self.beside = self.level == ASIDE
        self.main = above and parent.main or self.rank < ASIDE and (self.name in MAIN_ELEMENTS or "role=main" in label)
        dropped = self.name in ASIDE_ELEMENTS and not (self.name == "header" and above and parent.main)
        hidden = self.rank >= OUTER and self.name in INLINE_ELEMENTS
        self.aside = above and parent.aside or dropped or hidden
        self.seen: list[str] = []  # its own blocks and the digests of the elements in it
        self.constant = False  # all its text is the template's
        self.start = 0  # how many blocks come before it
        self.kept = False  # it holds the main text
        # Characters, without those of links, under no listed name, and under none of ASIDE_NAMES.
        self.free = self.text = 0


def digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def text_mark(path: str, text_digest: str) -> str:
    return f"#{text_digest}{path}"


def walk(page: str, template: Container[str]) -> Iterator[tuple[str, Element, str, int]]:
    """("open", element, "", 0), ("text", element, block, its characters in links), ("close", element,
    "", 0) and ("end", element, digest of all its text, or "" without any, 0) in page order; at last
    the end of the root.

    A path is that of the labels from the root. An element of the template ends whatever a slot
    before it left open, so damage in a slot stays there. "close" tells of a closing tag; one
    without an open element is left out, and one that skips elements ends them too. Text in elements
    that are never main text is left out.
    """
    stack = [Element("", "", True, None)]
    block: list[str] = []
    linked = 0
    met: set[str] = set()

    def taken() -> Iterator[tuple[str, Element, str, int]]:
        nonlocal linked
        text = " ".join(html.unescape("".join(block)).split())
        block.clear()
        if text:
            owner = next(e for e in reversed(stack) if e.name not in INLINE_ELEMENTS)
            owner.seen.append(text)
            yield "text", owner, text, min(linked, len(text))
        linked = 0

    def ended(depth: int) -> Iterator[tuple[str, Element, str, int]]:
        while len(stack) > depth:
            element = stack.pop()
            found = digest("\n".join(element.seen)) if element.seen else ""
            if found and stack:
                owner = next(e for e in reversed(stack) if e.name not in INLINE_ELEMENTS)
                owner.seen.append(f"\0{found}")
            yield "end", element, found, 0

    for kind, value in events(page):
        if kind == "text":
            if not stack[-1].aside:
                block.append(value)
                if any(e.name == "a" for e in stack):
                    linked += len(value)
            continue
        name = value.split(" ", 1)[0]
        if name not in INLINE_ELEMENTS or rank(value) >= OUTER:
            yield from taken()
        if kind == "close":
            depth = closes([e.label for e in stack], name)
            if depth >= 0:
                if any(e.aside for e in stack[depth:]):
                    yield from taken()
                element = stack[depth]
                yield from ended(depth)
                yield "close", element, "", 0
            continue
        yield from ended(closed_by([e.label for e in stack], name))
        if name in VOID_ELEMENTS:
            continue
        path = inside(stack[-1].path, value)
        anchored = path in template and path not in met
        if not anchored:
            anchor = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].anchored)
            path = inside(stack[anchor].path, value)
            anchored = path in template and path not in met
            if anchored:
                yield from ended(anchor + 1)
        if anchored:
            met.add(path)
        stack.append(Element(value, inside(stack[-1].path, value), anchored, stack[-1]))
        yield "open", stack[-1], "", 0
    yield from taken()
    yield from ended(0)


def inside(path: str, label: str) -> str:
    return f"{path}/{label}" if path else label


def tokens(page: str) -> tuple[Counter, dict[str, tuple[int, int]], str]:
    """How often each token occurs, the characters of its text, and the digest of the page's text.

    Tokens are the tags (< and > before the path of their element), each told apart by the elements
    around it, and the text of elements that stand once on the page: all text of the element, and
    each block of its own. A text counts once. Characters, those of links left out, are given under
    an element's opening tag for all text in it, and for each block.
    """
    counts: Counter = Counter()
    chars: dict[str, tuple[int, int]] = defaultdict(lambda: (0, 0))
    texts: list[tuple[str, str, tuple[int, int]]] = []
    blocks: dict[Element, list[tuple[str, str, tuple[int, int]]]] = defaultdict(list)
    whole = ""
    for kind, element, found, linked in walk(page, frozenset()):
        if kind == "open":
            counts[f"<{element.path}"] += 1
        elif kind == "close":
            counts[f">{element.path}"] += 1
        elif kind == "text":
            n = len(found) - linked
            size = (n if not element.level else 0, n if element.level <= OUTER else 0)
            element.free, element.text = element.free + size[0], element.text + size[1]
            blocks[element].append((element.path, digest(f"\1{found}"), size))
        elif kind == "end" and found:
            whole = found
            own = blocks.pop(element, [])
            if len(element.seen) > 1:
                texts += own
            texts.append((element.path, found, own[0][2] if own and len(element.seen) == 1 else (0, 0)))
            free, text = chars[f"<{element.path}"]
            chars[f"<{element.path}"] = free + element.free, text + element.text
            if element.parent is not None:
                element.parent.free += element.free
                element.parent.text += element.text
    for path, found, size in texts:
        if counts.get(f"<{path}") == 1:
            mark = text_mark(path, found)
            counts[mark] = 1
            chars[mark] = size
    return counts, chars, whole


def page_marks(page_id: int | None, url: str | None) -> tuple[int, int]:
    mark = blake2b(f"{page_id} {url}".encode(), digest_size=8).digest()
    return int.from_bytes(mark[:4], "little") >> 2, int.from_bytes(mark[4:], "little") >> 2


def host_column(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


SUMS = ["pages", "occurrences", "mark_a", "mark_b", "free", "text"]
STAT_NAMES = ["host", "token", *SUMS, "least", "most"]
STATS = "host string, token string, " + ", ".join(f"{name} long" for name in STAT_NAMES[2:])


def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a batch adds to each token's occurrence vector of its host.

    The vector, one count per page, is kept as two sums of counts times a random number of the
    page: equal vectors have equal sums, and sums of parts add up. With it go the least and the
    greatest digest of those pages' texts, which differ unless the pages all read the same.
    """
    for batch in batches:
        totals: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0] * 6 + [MOST, 0])
        ids, urls, hosts, pages = (batch.column(i).to_pylist() for i in range(4))
        for page_id, url, host, page in zip(ids, urls, hosts, pages):
            mark_a, mark_b = page_marks(page_id, url)
            counts, chars, whole = tokens(page)
            text = int(whole[:15] or "0", 16)
            for token, n in counts.items():
                total = totals[host, token]
                for j, x in enumerate((1, n, n * mark_a, n * mark_b, *chars[token])):
                    total[j] += x
                total[6], total[7] = min(total[6], text), max(total[7], text)
        rows = [(*key, *total) for key, total in totals.items()]
        columns = list(zip(*rows)) if rows else [[]] * len(STAT_NAMES)
        kinds = [pa.string()] * 2 + [pa.int64()] * 8
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=STAT_NAMES)


TEMPLATE = "host string, template array<struct<token: string, weight: double>>"


def slots(rows: pa.Table) -> pa.Table:
    """The template of one host: its elements with their weight, and its constant texts.

    The weight of an element is how much text that varies, and is no link, its pages have in it on
    average. Text in elements whose names mark what is beside the text does not count, unless more
    than half of all text would be left out for names that only mostly mean that.
    """
    names = ("path", "texts", "free", "text", "pages", "constant_free", "constant_text", "valid")
    given = list(zip(*(rows.column(name).to_pylist() for name in names)))
    weights = {path: [free, text] for path, _, free, text, *_, valid in given if valid}
    for path, _, _, _, _, free, text, _ in given:
        at = len(path)
        while text and at > 0:
            if path[:at] in weights:
                weights[path[:at]][0] -= free
                weights[path[:at]][1] -= text
            at = path.rfind("/", 0, at)
    most = [max((w[i] for w in weights.values()), default=0) for i in (0, 1)]
    use = 0 if most[0] >= LEAST_OF_TEXT * most[1] else 1
    found = [{"token": row[0], "weight": weights[row[0]][use] / row[4]} for row in given if row[-1]]
    found += [{"token": text, "weight": 0.0} for row in given for text in row[1]]
    found.sort(key=lambda t: t["token"])
    kind = pa.list_(pa.struct([("token", pa.string()), ("weight", pa.float64())]))
    return pa.table({"host": rows.column("host")[:1], "template": pa.array([found], kind)})


def templates(pages: DataFrame) -> DataFrame:
    """host and template: the elements of its valid classes with their weight, and their constant texts.

    Tokens with equal occurrence vectors over the pages of a host form a class. Valid are classes
    that hold both tags of an element, once on each page that has them, on one page in a hundred at
    least; larger counts mark lists, whose items are data. Paths nest the classes: an element
    of one lies in a slot of the class that its parents belong to. A text of such an element is
    constant if it is of the class of its opening tag, so that it stands word for word wherever the
    element does, on three pages at least that do not all read the same. All other text varies; how
    much of it an element holds says which slot is the article's.
    """
    given = pages.select("page_id", "url", host_column(F.col("url")).alias("host"), "html")
    stats = (
        given.mapInArrow(statistics, STATS)
        .groupBy("host", "token")
        .agg(
            *[F.sum(name).alias(name) for name in SUMS],
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
    )
    sizes = given.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    is_text, opens = F.col("token").startswith("#"), F.col("token").startswith("<")
    once = F.col("occurrences") == F.col("pages")
    shown = (F.col("pages") >= LEAST_TEXT_PAGES) & (F.col("least") < F.col("most"))
    path = F.when(is_text, F.expr("substring(token, 34)")).otherwise(F.expr("substring(token, 2)"))
    classes = (
        stats.filter(once & (~is_text | shown))
        .groupBy("host", path.alias("path"), "pages", "mark_a", "mark_b")
        .agg(
            F.count_if(~is_text).alias("tags"),
            F.bool_or(opens).alias("opens"),
            F.collect_list(F.when(is_text, F.col("token"))).alias("texts"),
            *[F.sum(F.when(opens, F.col(n))).alias(n) for n in ("free", "text")],
            *[F.sum(F.when(is_text, F.col(n)).otherwise(0)).alias(f"constant_{n}") for n in ("free", "text")],
        )
        .filter("opens AND (tags = 2 OR size(texts) > 0)")
        .join(sizes, "host")
        .filter(F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
    )
    return (
        classes.withColumn("valid", F.col("tags") == 2)
        .groupBy("host")
        .applyInArrow(slots, TEMPLATE)
    )


def above(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def article_slot(elements: list[Element], template: Mapping[str, float]) -> Element | None:
    """The slot that holds the article: from the root on, the element of the template with half of
    the text that varies, as long as there is one."""
    children: dict[int, list[Element]] = defaultdict(list)
    for element in elements:
        if element.anchored and template.get(element.path, 0) > 0 and element.parent is not None:
            owner = next(e for e in above(element.parent) if e.anchored)
            children[id(owner)].append(element)
    slot, whole = None, 0.0
    at = elements[0]
    while inner := children[id(at)]:
        best = max(inner, key=lambda e: template[e.path])
        if template[best.path] < LEAST_OF_TEXT * max(whole, sum(template[e.path] for e in inner)):
            break
        slot = at = best
        whole = template[best.path]
    return slot


def main_text(page: str, template: Mapping[str, float]) -> str:
    """The text of the article's slot, and what varies around it.

    Where the page has a main element that one is the slot, and only its text counts; else it is
    deduced. All text in the slot counts, also what other pages repeat; so does what stands between
    the headline and the slot. Around it, constant text of the template and blocks of links are left
    out. Everywhere, elements by whose names they are beside the text are left out, except those
    around the slot.
    """
    elements: list[Element] = []
    blocks: list[tuple[str, Element, bool, int]] = []
    for kind, element, found, linked in walk(page, template):
        if kind == "open":
            element.start = len(blocks)
            elements.append(element)
        elif kind == "text":
            blocks.append((found, element, text_mark(element.path, digest(f"\1{found}")) in template, linked))
        elif kind == "end" and found:
            element.constant = text_mark(element.path, found) in template
    if not blocks:
        return ""
    root = next(e for e in above(blocks[0][1]) if e.parent is None)
    marked = any(e.main and not e.beside for _, e, _, _ in blocks)
    is_main = {id(e) for _, e, _, _ in blocks if e.main and not (marked and e.beside)}
    slot = None if is_main else article_slot([root, *elements], template)
    holders = [e for e in elements if e.name in MAIN_ELEMENTS or "role=main" in e.label] if is_main else [slot]
    for holder in holders:
        for element in above(holder):
            element.kept = element.kept or not (marked and element.beside)

    def in_slot(element: Element) -> bool:
        return element.main if is_main else slot is not None and any(e is slot for e in above(element))

    heading = len(blocks)
    if slot is not None:
        titles = [e.start for e in elements if e.name == "h1" and e.start < slot.start]
        heading = max(titles, default=len(blocks))
    out = []
    for i, (text, owner, constant, linked) in enumerate(blocks):
        inside_slot = in_slot(owner)
        if is_main and not inside_slot:
            continue
        least = OUTER if inside_slot else FRAME
        if any(e.rank >= least and not e.kept for e in above(owner)):
            continue
        if not inside_slot and not is_main:
            if linked >= LINKED * len(text) and slot is not None:
                continue
            repeats = constant or any(e.constant for e in above(owner))
            if repeats and not (slot is not None and heading <= i < slot.start):
                continue
        out.append(text)
    return " ".join(out)


def extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, found = (batch.column(i).to_pylist() for i in range(4))
        texts = [
            main_text(page, {t["token"]: t["weight"] for t in template or ()}) for page, template in zip(pages, found)
        ]
        columns = [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])


SMALL_TEMPLATES = 64_000_000
SALTS = 64


def with_templates(given: DataFrame, found: DataFrame) -> DataFrame:
    """The pages, each with its host's template.

    Templates of at most SMALL_TEMPLATES bytes are broadcast. Larger ones are repeated for some salts,
    over which the pages of a host are spread, so a host with a third of all pages is many tasks' work.
    """
    host = host_column(F.col("url"))
    size = found.agg(
        F.sum(F.aggregate("template", F.lit(0).cast("long"), lambda n, t: n + 16 + F.octet_length(t["token"])))
    ).first()[0]
    if (size or 0) <= SMALL_TEMPLATES:
        joined = given.join(F.broadcast(found), host == F.col("template_host"), "left")
    else:
        salted = found.withColumn("template_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("page_id", "url", F.octet_length("html")), F.lit(SALTS))
        joined = given.join(salted, (host == F.col("template_host")) & (salt == F.col("template_salt")), "left")
    return joined.select("page_id", "url", "html", "template")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars: the main text of every page.

    The templates of all hosts are deduced from all their pages and written to the shared folder,
    then joined to the pages. Of a template's slots, the one with most of the varying text is the
    article's. All its text counts, also what other pages repeat, such as the headline of several
    revisions. Around it, text that the host's pages repeat word for word and blocks of links are
    left out, and so is everything outside of an article or main element where a page has one.
    Without a template (hosts of a page or two) nothing is constant.

    Character references are decoded, white space within a block becomes one space, and blocks are
    joined in page order. Left out everywhere are menus, footers, sidebars, adverts, forms, scripts,
    styles and reader comments, told by the names of elements and by whole names in their class, id
    or role; headers and notices only outside of the article. An element around the article's slot is
    never left out for a name. A null page is empty, and a page without text gives an empty text. A
    null url belongs to the host of the empty name. Repeated rows give equal rows. Other columns are
    ignored. Very long pages are taken whole. An empty table gives no rows.
    """
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    )
    found = written(templates(given), "html-templates").withColumnRenamed("host", "template_host")
    texts = with_templates(given, found).mapInArrow(extractor, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
