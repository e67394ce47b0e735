"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page is read into block nodes (inline elements count as text of their block). Each node gets
features of itself (tag group, words of its class, id and role, depth, own text), of its subtree
(text length, share of the page's text, density of tags and links, paragraphs), of its siblings,
and of its ancestors. The trees give each node the probability that it holds article text.

Decoding is hierarchical: a node that is left out takes its whole subtree along, and a kept node's
ancestors are kept. Among those consistent choices the likeliest is found in one pass up (the best
value of each subtree, kept or left out) and one down.

No page is labelled, so the trees are taught by construction: from a bounded sample of pages whose
markup names its article, variants are made in which the names of containers are changed or taken
away and blocks of known role, filled with words of other pages, are put in. Their roles are known,
and what they teach are the features that remain. Whole pages made from the words of the table's pages
teach in the same way beside them, so that tables whose pages name no article are read too.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import gbdt
from quayside.llm.registry import query, table

SAMPLE, PAGE_CHARS, VARIANTS = 200, 60_000, 3  # pages that teach, and the longest of them
MADE = 40  # made pages that teach beside them, however many there are
FILLERS, FILLER_WORDS = 50, 400  # pages whose first words fill made blocks and pages

# Fixed values from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())  # text up to their end tag
DROPPED = frozenset("button select template iframe".split())  # never text of a page
PHRASING = DROPPED | {"noscript", "object", "svg"}  # without text they don't part the text around them
INLINE = frozenset((
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub "
    "msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation "
    "g path circle ellipse line polyline polygon rect text tspan textpath defs use symbol stop marker mask "
    "clippath lineargradient radialgradient pattern filter").split())
CLOSES_P = frozenset((
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul").split())
CLOSED_BY_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "option": {"option"},
}
SCOPES = frozenset("table ul ol dl body html article section div".split())
# Tag groups, and words that names of containers are made of.
GROUPS = {
    "article": {"article", "main"}, "section": {"section", "div", "center"}, "p": {"p", "blockquote", "pre"},
    "heading": {"h1", "h2", "h3", "h4", "h5", "h6"}, "list": {"ul", "ol", "dl", "menu"}, "item": {"li", "dt", "dd"},
    "table": {"table", "tbody", "tr", "td", "th", "thead"}, "nav": {"nav"}, "header": {"header"},
    "footer": {"footer"}, "aside": {"aside"}, "form": {"form", "fieldset"}, "head": {"head"},
    "figure": {"figure", "figcaption"},
}
PLAIN_WORDS = frozenset("article articlebody body content entry main post story text prose".split())
OTHER_WORDS = frozenset((
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form header login masthead menu nav navbar navigation newsletter notice notification "
    "pagination popup promo promoted related replies reply respond search share sharing sidebar signup "
    "social sponsor sponsored subscribe tags teaser toolbar topbar widget").split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*")
_END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}
_NEXT_OF = {tag: re.compile(rf"<(/?){tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in DROPPED}
_GROUP_OF = {tag: k for k, tags in enumerate(GROUPS.values()) for tag in tags}
_ROOT = ("html", "body", "#page")


class Page:
    """Block nodes in document order, parents first, and the text segments they own."""

    def __init__(self, source: str):
        self.tag, self.parent, self.names, self.part = ["#page"], [-1], [""], [0]
        self.segments: list[list] = []  # [node, [texts], characters in links]
        stack = [(0, "#page", -1, 0, 0)]  # (node, tag, and before it: segment, number of segments, links)
        current, at, links = -1, 0, 0
        hidden = unclosed = 0  # depth in the stack of a dropped element; of one that has no end tag
        places: dict[str, list[int]] = {}  # where in the stack each tag was put, with places left since

        def put(node: int, tag: str, *before: int) -> None:
            places.setdefault(tag, []).append(len(stack))
            stack.append((node, tag, *before))

        def topmost(tag: str) -> int:
            """The place of the last open element of a tag, or 0; a place that was left is looked at once."""
            known = places.get(tag, [])
            while known and (known[-1] >= len(stack) or stack[known[-1]][1] != tag):
                known.pop()
            return known[-1] if known else 0

        while at < len(source):
            m = _TOKEN.match(source, at)
            if m is None:
                break
            at = m.end()
            tag = m.group(2)
            if tag is None:
                word = m.group()
                if word[0] == "<" and word != "<":
                    continue
                if hidden:
                    continue
                if current < 0:
                    self.segments.append([stack[-1][0], [], 0])
                    current = len(self.segments) - 1
                self.segments[current][1].append(word)
                if links:
                    self.segments[current][2] += len(word)
                continue
            tag = tag.lower()
            inline = tag in INLINE
            if hidden and inline:
                continue
            if unclosed and not m.group(1) and (tag in CLOSES_P or tag in DROPPED):
                current, _, links = stack[unclosed][2:]  # a control without an end tag holds no blocks
                del stack[unclosed:]
                hidden = unclosed = 0
            if m.group(1):
                if inline:
                    links -= tag == "a" and links > 0
                    continue
                k = topmost(tag)
                if tag == "p" and not k:
                    current = -1
                    continue
                before = (-1, 0)
                if k:
                    if tag in PHRASING and stack[k][3] == len(self.segments):
                        before = (stack[k][2], stack[k][4])
                    del stack[k:]
                if hidden >= len(stack):
                    hidden = unclosed = 0
                if not hidden:
                    current, links = before
                continue
            if tag in RAW:
                if not m.group(3).endswith("/"):
                    end = _END_OF[tag].search(source, at)
                    at = end.start() if end else len(source)
                continue
            if tag in PHRASING and m.group(3).endswith("/"):
                continue
            resume = (current, len(self.segments), links)
            if tag in DROPPED and not hidden:
                hidden = len(stack)
                after = _NEXT_OF[tag].search(source, at)
                unclosed = 0 if after and after.group(1) else hidden
                put(stack[-1][0], tag, *resume)
                continue
            if inline:
                if tag == "br" and current >= 0:
                    self.segments[current][1].append(" ")
                links += tag == "a" and links == 0
                continue
            current = -1
            if tag in ("html", "body") and topmost(tag):
                continue
            if tag == "body" and stack[-1][1] == "head":
                stack.pop()
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0 if unclosed else hidden, -1):
                    if stack[k][1] == "p":
                        del stack[k:]
                        break
                    if stack[k][1] in SCOPES:
                        break
            if tag in CLOSED_BY_SAME:
                for k in range(len(stack) - 1, 0 if unclosed else hidden, -1):
                    if stack[k][1] in CLOSED_BY_SAME[tag]:
                        del stack[k:]
                    elif stack[k][1] in SCOPES:
                        break
            if hidden >= len(stack):
                hidden = unclosed = 0
            if tag in VOID:
                continue
            if hidden:
                put(stack[-1][0], tag, *resume)
                continue
            node = len(self.tag)
            self.tag.append(tag)
            self.parent.append(stack[-1][0])
            names = " ".join(next(filter(None, g), "") for g in _NAMES.findall(m.group(3))) if m.group(3) else ""
            self.names.append(names)
            self.part.append(len(self.segments))
            links = 0
            put(node, tag, *resume)
        self.texts = [" ".join(entities.unescape("".join(parts)).split()) for _, parts, _ in self.segments]


def features(page: Page) -> np.ndarray:
    """A row per node."""
    n = len(page.tag)
    own, linked, marks, count = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for (node, _, in_links), text in zip(page.segments, page.texts):
        if text:
            own[node] += len(text)
            linked[node] += min(in_links, len(text))
            marks[node] += text.count(".") + text.count(",")
            count[node] += 1
    groups, words = len(GROUPS), 2
    self_flags = np.zeros((n, groups + words))
    for k, (tag, names) in enumerate(zip(page.tag, page.names)):
        g = _GROUP_OF.get(tag)
        if g is not None:
            self_flags[k, g] = 1
        if names:
            got = {w.lower() for w in _WORD.findall(names)} | set(names.lower().split())
            self_flags[k, groups] = len(got & PLAIN_WORDS)
            self_flags[k, groups + 1] = len(got & OTHER_WORDS)
    parent = page.parent
    above, depth = np.zeros_like(self_flags), np.zeros(n)
    size, text, link, mark, blocks, paragraphs, children = np.ones(n), own.copy(), linked.copy(), marks.copy(), count.copy(), self_flags[:, 2].copy(), np.zeros(n)
    nth, same = np.zeros(n), np.zeros(n)
    brothers: dict[tuple[int, str], int] = {}
    for k in range(1, n):
        up = parent[k]
        above[k] = above[up] + self_flags[up]
        depth[k] = depth[up] + 1
        nth[k] = children[up]
        children[up] += 1
        brothers[up, page.tag[k]] = brothers.get((up, page.tag[k]), 0) + 1
    for k in range(n - 1, 0, -1):
        up = parent[k]
        for a in (size, text, link, mark, blocks, paragraphs):
            a[up] += a[k]
    for k in range(1, n):
        same[k] = brothers[parent[k], page.tag[k]]
    up = np.maximum(np.array(parent), 0)
    whole = max(text[0], 1)
    before = np.concatenate([[0.0], np.cumsum([len(t) for t in page.texts])])
    return np.column_stack([
        self_flags, np.minimum(above, 2), np.minimum(depth, 12), np.log1p(own), np.log1p(text), text / whole,
        text / np.maximum(text[up], 1), np.log1p(size), size / (1 + text / 100), link / np.maximum(text, 1),
        mark / np.maximum(text, 1) * 100, text / np.maximum(blocks, 1), np.log1p(paragraphs), np.log1p(children),
        np.log1p(nth), (nth + 1) / np.maximum(children[up], 1), np.log1p(same), np.log1p(children[up]),
        link[up] / np.maximum(text[up], 1), before[np.array(page.part)] / whole,
    ]).astype(np.float32)


def decode(page: Page, probability: np.ndarray) -> np.ndarray:
    """Which nodes to keep. The page's own frame (html, body) is always kept; what stands in it
    without a block of its own counts as text of its node."""
    n = len(page.tag)
    weight = np.full(n, 0.5)
    for (node, _, _), text in zip(page.segments, page.texts):
        weight[node] += np.log1p(len(text))
    p = np.clip(probability, 1e-4, 1 - 1e-4)
    keep, drop = (weight * np.log(p)).tolist(), (weight * np.log(1 - p)).tolist()
    parent, tag = page.parent, page.tag
    for k in range(n - 1, 0, -1):
        up = parent[k]
        drop[up] += drop[k]
        keep[up] += max(keep[k], drop[k])
    kept = np.zeros(n, bool)
    kept[0] = True
    for k in range(1, n):
        kept[k] = kept[parent[k]] and (tag[k] in _ROOT or keep[k] > drop[k])
    return kept


def main_text(page: Page, kept: np.ndarray, probability: np.ndarray) -> str:
    """The kept blocks in page order; text of the frame itself only where the trees want it."""
    return "\n\n".join(
        text for (node, _, _), text in zip(page.segments, page.texts)
        if text and kept[node] and (page.tag[node] not in _ROOT or probability[node] > 0.5))


# ---- teaching -------------------------------------------------------------------------------

_HOLD = 'data-keep="1"'
_OPEN = re.compile(r"<(article|main)(?=[\s>])", re.I)


def variants(source: str, words: np.ndarray, rng: np.random.Generator, many: int) -> list[tuple[str, bool]]:
    """Pages made of one page: containers renamed, blocks of known role put in. The article's
    start tag carries a mark that only ``teach`` reads."""
    if not _OPEN.search(source):
        return []
    marked = _OPEN.sub(lambda m: m.group() + " " + _HOLD, source, count=1)

    def phrase(least: int, most: int) -> str:
        return entities.escape(" ".join(words[rng.integers(0, len(words), int(rng.integers(least, most)))]))

    def paragraphs(many: int, least: int, most: int) -> str:
        return "".join(f"<p>{phrase(least, most)}.</p>" for _ in range(many))

    def listing(many: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{phrase(1, 5)}</a></li>' for k in range(many)) + "</ul>"

    def blocks() -> list[tuple[str, str]]:
        few = int(rng.integers(1, 5))
        return [
            ("before", f"<header><div class=\"logo\">{phrase(1, 4)}</div>{listing(few + 2)}</header>"),
            ("before", f'<div class="{rng.choice(["menu", "navbar", "top-nav", "breadcrumbs"])}">{listing(few + 3)}</div>'),
            ("before", f'<div class="{rng.choice(["cookie-notice", "banner", "notice", "consent"])}"><p>{phrase(8, 25)}.</p></div>'),
            ("before", f'<div id="{rng.choice(["header", "masthead", "topbar"])}"><h2>{phrase(1, 4)}</h2></div>'),
            ("after", f'<aside class="{rng.choice(["sidebar", "related", "widget"])}"><h3>{phrase(1, 4)}</h3>{listing(few + 2)}<p>{phrase(4, 12)}</p></aside>'),
            ("after", f'<div class="{rng.choice(["sidebar", "related-posts", "promo", "share"])}"><h3>{phrase(1, 3)}</h3>{listing(few + 2)}</div>'),
            ("after", f'<{"section" if few % 2 else "div"} {rng.choice(["id", "class"])}="comments"><h3>{phrase(1, 3)}</h3>'
                      + "".join(f'<div class="comment">{paragraphs(int(rng.integers(1, 3)), 8, 60)}</div>' for _ in range(few)) + f'</{"section" if few % 2 else "div"}>'),
            ("after", f'<form class="{rng.choice(["newsletter", "search", "login-form"])}"><label>{phrase(1, 4)}</label><input name="q"><p>{phrase(3, 12)}</p></form>'),
            ("after", f'<div class="{rng.choice(["footer", "site-footer"])}"><p>&copy; {phrase(3, 12)}</p></div>'),
            ("inside", f'<div class="{rng.choice(["ad", "advert", "sponsored", "promo", "share-buttons"])}">{phrase(3, 14)}</div>'),
            ("inside", f'<aside>{phrase(4, 20)}</aside>'),
            ("plain", f'<blockquote><p>{phrase(8, 40)}.</p></blockquote>'), ("plain", f"<h2>{phrase(2, 7)}</h2>{paragraphs(1, 15, 70)}"),
            ("plain", f"<ul>{''.join(f'<li>{phrase(4, 18)}</li>' for _ in range(few + 1))}</ul>"),
            ("plain", f"<table><tr><td>{phrase(1, 4)}</td><td>{phrase(1, 4)}</td></tr></table>"),
        ]

    out = [(marked, True)]
    for _ in range(many):
        page = marked
        made = blocks()
        for place, block in (made[k] for k in rng.permutation(len(made))[:int(rng.integers(2, 8))]):
            begin = page.find("<article") if "<article" in page else page.find("<main")
            end = max(page.rfind("</article"), page.rfind("</main"))
            end = len(page) if end < 0 else end
            mark = block.replace(">", ' data-drop="1">', 1) if place != "plain" else block
            if place == "before":
                page = page[:begin] + mark + page[begin:]
            elif place == "after":
                stop = page.find(">", end) + 1 if end < len(page) else end
                page = page[:stop] + mark + page[stop:]
            else:
                cuts = [m.end() for m in re.finditer("</p>", page[begin:end])]
                at = begin + (int(rng.choice(cuts)) if cuts else page[begin:end].find(">") + 1)
                page = page[:at] + mark + page[at:]
        if rng.random() < 0.6:  # the article by another name, or by none
            name = rng.choice(["article", "main", "div", "section"])
            label = rng.choice(["", ' class="content"', ' class="post entry"', ' id="main"', ' class="story"', ' class="x1"'])
            page = re.sub(r"<(article|main)(?=[\s>])", f"<{name}{label}", page, count=1)
            page = re.sub(r"</(article|main)>", f"</{name}>", page)
        for tag in ("nav", "footer", "header", "aside"):
            if rng.random() < 0.3:
                label = rng.choice([f' class="{tag}"', f' id="{tag}"', ' class="c2"'])
                page = re.sub(rf"<{tag}(?=[\s>])", f"<div{label}", page)
                page = page.replace(f"</{tag}>", "</div>")
        out.append((page, True))
    return out


def made_pages(pages: list[str], many: int, seed: int = 80) -> list[str]:
    """Pages with a named article, made from the words that pages of any markup show."""
    rng = np.random.Generator(np.random.PCG64(seed))
    shown = [w for p in pages for t in Page(p).texts for w in t.split()[:FILLER_WORDS]]
    words = np.array(shown or ["text"], object)

    def phrase(least: int, most: int) -> str:
        return entities.escape(" ".join(words[rng.integers(0, len(words), int(rng.integers(least, most)))]))

    def listing(many: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{phrase(1, 4)}</a></li>' for k in range(many)) + "</ul>"

    def article() -> str:
        parts = []
        for _ in range(int(rng.integers(2, 14))):
            parts.append(f"<h2>{phrase(2, 7)}</h2>" if rng.random() < 0.15 else "")
            parts.append(f"<p>{phrase(10, 110)}, {phrase(3, 30)}.</p>")
        return f"<h1>{phrase(2, 9)}</h1>" + "".join(parts)

    out = []
    for _ in range(many):
        held = f"<article>{article()}</article>"
        for _ in range(int(rng.integers(0, 3))):
            held = f'<div {rng.choice(["id", "class"])}="{rng.choice(["wrapper", "page", "container", "c3"])}">{held}</div>'
        head = f"<header><div>{phrase(1, 4)}</div></header>" if rng.random() < 0.6 else ""
        menu = f"<nav>{listing(int(rng.integers(2, 9)))}</nav>" if rng.random() < 0.8 else ""
        foot = f"<footer><p>{phrase(2, 14)}</p></footer>" if rng.random() < 0.8 else ""
        out.append(f"<html><head></head><body>{head}{menu}{held}{foot}</body></html>")
    return out


def teach(pages: list[str], seed: int = 8) -> dict:
    """Trees from sample pages; a page without a named article teaches nothing."""
    rng = np.random.Generator(np.random.PCG64(seed))
    words = np.array([w for p in pages[:FILLERS] for w in re.sub(r"<[^>]*>", " ", p).split()[:FILLER_WORDS]] or ["text"], object)
    rows, labels = [], []
    for source in pages:
        for made, _ in variants(source, words, rng, VARIANTS):
            page = Page(made)
            role = _roles(made, page)
            rows.append(features(page))
            labels.append(role)
    if not rows:
        return gbdt.fit(np.zeros((0, 1)), np.zeros(0))
    return gbdt.fit(np.concatenate(rows), np.concatenate(labels).astype(float), rounds=40, depth=5, least=2.0)


def _roles(source: str, page: Page) -> np.ndarray:
    """1 for nodes with article text below or in them, 0 for all others: from the marks that
    ``variants`` set, in the order of the nodes, and from what names of nodes in an article say."""
    opened = [m for m in _TOKEN.finditer(source) if m.group(2) and not m.group(1)]
    marks = iter([
        (m.group(2).lower(), 1 if _HOLD in m.group(3) else -1 if "data-drop" in m.group(3) else 0)
        for m in opened])
    state = np.zeros(len(page.tag), int)
    for k in range(1, len(page.tag)):
        mark = next((x for t, x in marks if t == page.tag[k]), 0)
        inherited = state[page.parent[k]]
        named = {w.lower() for w in _WORD.findall(page.names[k])} & OTHER_WORDS - {"header"}
        other = page.tag[k] in ("nav", "aside", "form", "footer") or bool(named)
        state[k] = -1 if mark < 0 or inherited < 0 or other and mark == 0 else 1 if mark > 0 or inherited > 0 else 0
    label = (state > 0).astype(int)
    for k in range(len(page.tag) - 1, 0, -1):
        label[page.parent[k]] |= label[k]
    return label


def _by_hash(pages: DataFrame, many: int) -> list[str]:
    """The ``many`` different contents of the smallest hashes, or all if there are fewer."""
    key = F.xxhash64("html").alias("key")
    keys = [r["key"] for r in pages.select(key).distinct().orderBy("key").limit(many).collect()]
    if not keys:
        return []
    rows = pages.select(key, "html").filter(F.col("key").isin(keys)).dropDuplicates(["key"]).collect()
    return [r["html"] for r in sorted(rows, key=lambda r: r["key"])]


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, text and n_chars of every page.

    Null and empty pages have an empty text. Broken markup is read as far as it goes: an element
    that isn't closed ends with its parent, an unclosed form control before the next block, an
    unfinished comment, script, style, title or textarea at the end of the page.
    Learns from ``SAMPLE`` pages, or all if there are fewer, among the different ones of at most
    ``PAGE_CHARS`` characters that name their article: those of the smallest content hashes, so that
    neither other pages nor copies change how many teach. ``MADE`` pages made from words of the
    table's pages teach as well. Longer pages are extracted as any other. Repeated rows give repeated
    rows; other columns are left out.
    """
    spark = pages.sparkSession
    content = F.col(html)
    named = content.rlike("(?i)<(article|main)[\\s>]") & (F.length(content) <= PAGE_CHARS)
    sample = _by_hash(pages.filter(named).select(content.alias("html")), SAMPLE)
    shown = _by_hash(pages.filter(F.length(content).between(1, PAGE_CHARS)).select(content.alias("html")), FILLERS)
    if not shown:  # there are only longer pages
        shown = _by_hash(pages.filter(F.length(content) > 0).select(F.substring(content, 1, PAGE_CHARS).alias("html")), FILLERS)
    sample += made_pages(shown, MADE) if shown else []
    model = teach(sample)
    shared = spark.sparkContext.broadcast(model)
    source = pages.select(*keep, content.alias("_html"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                some = batch.slice(a, 128)
                read = [Page(s or "") for s in some.column("_html").to_pylist()]
                table_ = [features(p) for p in read]
                scored = gbdt.predict(shared.value, np.concatenate(table_))
                ends = np.cumsum([len(t) for t in table_])
                texts = [main_text(p, decode(p, q), q) for p, q in zip(read, np.split(scored, ends[:-1]))]
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(some.schema.get_field_index(c)) for c in keep], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    [*keep, "text", "n_chars"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return source.mapInArrow(rows, f"{kept}, text string, n_chars long")


@query("op8_html_extract")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
