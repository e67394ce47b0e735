"""Elements of HTML pages as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import paths

# What holds no elements: comments, and the content of scripts and styles.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def visible(html: Column) -> Column:
    return F.regexp_replace(html, HIDDEN, "")


# Elements that the next start of their kind may end.
IMPLIED_END = ("a", "dd", "dt", "li", "option", "p", "td", "th", "tr")


def start_tag(tag: str) -> str:
    return rf"(?is)<{tag}(?=[\s/>])[^>]*>"


def end_tag(tag: str) -> str:
    return rf"(?is)</{tag}\s*>"


def _pieces(body: Column, tag: str) -> Column:
    """The start tags of a kind, each with what follows up to the next one."""
    rest = F.split(body, start_tag(tag))
    return F.arrays_zip(
        F.regexp_extract_all(body, F.lit(start_tag(tag)), F.lit(0)).alias("start"),
        F.slice(rest, F.lit(2), F.greatest(F.size(rest) - 1, F.lit(0))).alias("rest"),
    )


def elements(pages: DataFrame, tag: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """The elements of a tag, such as table, tr or form, with their place in the page and content.

    Every start tag is an element. It ends at its own end tag, counting those of elements inside it;
    one of IMPLIED_END at the next end or start tag of its kind; else at the end of the page.
    """
    ending = end_tag(tag)
    body = visible(F.col(html))
    if tag.lower() in IMPLIED_END:
        one = pages.select(key, F.posexplode(_pieces(body, tag)).alias("pos", "_e"))
        return one.select(key, "pos", F.split(F.col("_e.rest"), ending)[0].alias("content"))
    return _nested(pages.select(key, body.alias("_body")), tag, key)


def _nested(pages: DataFrame, tag: str, key: str) -> DataFrame:
    """Elements whose ends are matched by depth.

    A page is cut at its tags of the kind. A start tag adds one to the depth and an end tag takes
    one off, so their prefix sums are the depths, and the first tag after a start tag that leaves
    the start tag's depth is its end: the next one of that page and depth. Contents are then cut
    out of the pieces of the page, which stay in one row. A page has a number of its own here,
    as its key may be missing or occur twice; one shuffle brings the tags of a page together.
    """
    either = rf"(?is)<{tag}(?=[\s/>])[^>]*>|</{tag}\s*>"
    pieces = F.split("_body", either, -1)
    tags = F.concat(F.regexp_extract_all("_body", F.lit(either), F.lit(0)), F.array(F.lit("")))
    cut = pages.withColumn("_page", F.monotonically_increasing_id()).select(
        key, "_page", F.posexplode(F.arrays_zip(pieces.alias("text"), tags.alias("tag"))).alias("_at", "_p"))
    turn = F.when(F.col("_p.tag") == "", 0).when(F.startswith("_p.tag", F.lit("</")), -1).otherwise(1)
    deep = cut.withColumn("_turn", turn).withColumn(
        "_depth", F.sum("_turn").over(Window.partitionBy("_page").orderBy("_at")))
    # The depth a start tag leads to, and the one an end tag leaves.
    level = F.when(F.col("_turn") == -1, F.col("_depth") + 1).when(F.col("_turn") == 1, F.col("_depth"))
    ended = deep.withColumn("_level", level).withColumn("_end", F.when(F.col("_turn") == 1, F.lead("_at").over(
        Window.partitionBy("_page", "_level").orderBy("_at"))))
    whole = ended.groupBy("_page").agg(
        F.first(key).alias(key),
        F.array_sort(F.collect_list(F.struct("_at", "_p", "_turn", "_end"))).alias("_all"),
    ).filter(F.size("_all") > 1)
    # Piece k lies before tag k; the content of an element goes from behind its start tag to its end tag.
    starts = F.filter("_all", lambda e: e["_turn"] == 1)

    def content(e: Column) -> Column:
        first = e["_at"] + 1
        size = F.coalesce(e["_end"], F.size("_all") - 1) - first
        inner = F.transform(F.slice("_all", first + 1, size), lambda p: F.concat(p["_p"]["text"], p["_p"]["tag"]))
        last = F.element_at("_all", first + size + 1)["_p"]["text"]
        return F.concat(F.array_join(inner, ""), last)

    return whole.select(key, F.posexplode(F.transform(starts, content)).alias("pos", "content"))


def element_counts(pages: DataFrame, tags: Sequence[str], key: str = "page_id", html: str = "html") -> DataFrame:
    """How many elements of each tag a page has, by their start tags: counted inside the row, one scan, no shuffle. What
    is hidden is taken out once for all tags."""
    counts = [
        F.struct(
            F.lit(t).alias("tag"),
            F.regexp_count("_body", F.lit(start_tag(t))).cast("long").alias("n"),
        )
        for t in tags
    ]
    bodies = pages.select(key, visible(F.col(html)).alias("_body"))
    return bodies.select(key, F.inline(F.array(*counts)))


# The target of a start tag: in double quotes, in single ones, or bare.
HREF = r"""(?is)(?<=[\s"'])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Every link with its place in the page, target and text. A page is searched once; target and
    text are then taken from the short matches. No shuffle."""
    matches = F.filter(_pieces(visible(F.col(html)), "a"), lambda e: F.rlike(e["start"], F.lit(HREF)))
    return pages.select(key, F.posexplode(matches).alias("pos", "_a")).select(
        key, "pos", F.concat(*[F.regexp_extract("_a.start", HREF, i) for i in (1, 2, 3)]).alias("href"),
        F.split(F.col("_a.rest"), end_tag("a"))[0].alias("text"),
    )


def new_links(found: DataFrame, known: DataFrame, text_pattern: str) -> DataFrame:
    """Link targets whose text matches from its start and that are not catalogued yet."""
    wanted = found.filter(paths.matches(F.col("text"), text_pattern)).select("href", "text").distinct()
    return wanted.join(known.select("href").distinct(), "href", "left_anti")
