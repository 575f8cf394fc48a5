"""Main text of web pages by template deduction from equivalence classes of tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import markup
from orderloom.llm.common import text_of, visit
from orderloom.llm.url_filter import parsed
from orderloom.session import shared_dir
from orderloom.sources.tables import written

# A class of tokens belongs to a host's template when it is on so many pages and so large a share of them.
MIN_PAGES = 8
MIN_SUPPORT = 0.85
MIN_TOKENS = 3

_TOKENS = pa.list_(
    pa.struct([("path", pa.string()), ("words", pa.int64()), ("n", pa.int32()), ("chars", pa.int64())])
)


def _text_key(text: str) -> int:
    """A text token's number; 0 is left for tags."""
    return xxhash.xxh64_intdigest(" ".join(text.split())) >> 1 | 1


def page_tokens(source: str) -> list[dict]:
    """The distinct tokens of a page: its elements by path, and its texts by path and words.

    ``n`` counts a token's occurrences and ``chars`` the text in all that is nested in an element's
    occurrences, boilerplate left out. A mere block of text has none, so is never a template's main element.
    """
    found, paths = markup.nodes(source)
    tags = Counter(paths)
    texts = Counter((node.path, _text_key(markup.plain(node.text))) for node in found)
    chars: Counter = Counter()
    for node in found:
        if not node.boilerplate:
            path = node.path.rpartition(">")[0]
            while path:
                chars[path] += len(node.text)
                path = path.rpartition(">")[0]
    rows = [{"path": path, "words": 0, "n": n, "chars": chars[path]} for path, n in tags.items()]
    return rows + [{"path": path, "words": words, "n": n, "chars": 0} for (path, words), n in texts.items()]


def _tokens(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in pages:
        yield pa.array([page_tokens(source) for source in batch.to_pylist()], _TOKENS)


def token_classes(
    pages: DataFrame, source: str = "html", host: str = "host",
    min_pages: int = MIN_PAGES, min_support: float = MIN_SUPPORT,
) -> DataFrame:
    """Tokens with the class they are in: ``host, path, words, chars, n_pages, n_seen, vector, size,
    elements``.

    Pages of a host with the same source count once: copies say nothing about a
    template. Tokens of a host are of one class when they occur equally often on every
    page: ``vector`` is a fingerprint of those counts, built by aggregation, so
    that no task holds a host's pages. ``size`` counts the class's tokens and
    ``elements`` those that are elements. Only tokens of frequent classes are returned.
    """
    tokens = visit(_tokens, "array<struct<path:string,words:long,n:int,chars:long>>")
    read = pages.select(F.col(f"`{host}`").alias("host"), text_of(source).alias("source"))
    distinct = read.groupBy("host", F.unhex(F.md5("source")).alias("content")).agg(F.first("source").alias("source"))
    hosts = distinct.select("host", F.xxhash64("content").alias("page"), F.explode(tokens("source")).alias("token"))
    hosts = hosts.select("host", "page", "token.*")
    counted = hosts.groupBy("host", "path", "words").agg(
        F.count("*").alias("n_pages"),
        F.sum("n").alias("n_seen"),
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
        F.sum("chars").alias("chars"),
    )
    frequent = counted.filter(F.col("n_pages") >= min_pages)
    contents = read.select("host", F.unhex(F.md5("source")).alias("content")).distinct()
    totals = contents.groupBy("host").agg(F.count("*").alias("total"))
    shared = frequent.join(totals, "host").filter(F.col("n_pages") >= F.col("total") * min_support).drop("total")
    # The sizes of classes need these few rows a second time.
    shared = written(shared, shared_dir(pages.sparkSession, "page-tokens"))
    sizes = shared.groupBy("host", "n_pages", "n_seen", "vector").agg(
        F.count("*").alias("size"), F.count_if(F.col("words") == 0).alias("elements")
    )
    return shared.join(sizes, ["host", "n_pages", "n_seen", "vector"])


def templates(classes: DataFrame, min_tokens: int = MIN_TOKENS, main_share: float = 0.8) -> DataFrame:
    """One row per host: ``host, texts, main``.

    Valid classes are large enough and hold elements; a class whose elements
    stand inside those of another is nested in it. ``texts`` are the text tokens
    that occur once on each page together with the page's frame, so are part of
    the template. ``main`` is the path of the innermost once-per-page element
    that holds ``main_share`` of the text in all slots, boilerplate left out.
    """
    valid = classes.filter((F.col("size") >= min_tokens) & (F.col("elements") > 0) & (F.col("n_pages") == F.col("n_seen")))
    text = F.col("words") != 0
    frames = valid.groupBy("host").agg(
        F.collect_set(F.when(text, F.struct("path", "words"))).alias("texts"),
        F.collect_set(F.when(~text, F.struct(F.length("path").alias("depth"), "path", "chars"))).alias("frame"),
    )
    most = F.array_max(F.transform("frame", lambda t: t.chars))
    holding = F.filter("frame", lambda t: (t.chars > 0) & (t.chars >= most * main_share))
    return frames.select("host", "texts", F.array_max(holding).getField("path").alias("main"))


def extract_page(source: str, texts: set[tuple[str, int]], main: str | None) -> str:
    """The main text of one page, given its host's template.

    The slots of the template's main element come first, all nested in it included. Names of boilerplate and
    the page's article then choose among these; where a page has no such element, among all of the page.
    """
    found, paths = markup.nodes(source)
    kept = [node for node in found if not node.boilerplate]
    if main is not None and main in paths:
        inside = [node for node in kept if node.path == main or node.path.startswith(f"{main}>")]
        kept = inside or kept
    if any(node.article for node in kept):
        kept = [node for node in kept if node.article]
    elif texts:
        kept = [node for node in kept if (node.path, _text_key(markup.plain(node.text))) not in texts]
    return "\n\n".join(markup.blocks(kept))


def _extracted(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for sources, texts, mains in batches:
        rows = zip(sources.to_pylist(), texts.to_pylist(), mains.to_pylist(), strict=True)
        yield pa.array(
            [extract_page(s, {(t["path"], t["words"]) for t in known or ()}, main) for s, known, main in rows],
            pa.string(),
        )


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Pages of one host share a template, deduced from the tokens that occur
    alike on their distinct contents (see :func:`token_classes`). Only the slots in the template's main
    element are main text, whatever stands around it; a page that lacks that element, and a host with
    too few pages for a template, take all slots. Of these, boilerplate by element or whole name is left out (menus,
    headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments); those in the page's
    article count if it has one, whole; if not, all but the template's texts.

    NULL, empty and text-free pages have the empty text. Pages without a host
    form one group. Repeated rows each have their result, and an empty table none. Of ``pages`` only the three
    columns are read, so others may have any name. Texts and nesting may be of any length and depth.
    """
    hosts = parsed(pages.select(page, url, source), url)
    known = written(templates(token_classes(hosts, source)), shared_dir(pages.sparkSession, "page-templates"))
    rows = hosts.join(known, "host", "left")
    text = visit(_extracted, "string")(text_of(source), F.col("texts"), F.col("main"))
    return rows.select(
        F.col(f"`{page}`").alias("page_id"), F.col(f"`{url}`").alias("url"), text.alias("text")
    ).withColumn("n_chars", F.char_length("text").cast("long"))
