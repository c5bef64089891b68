"""Main text of web pages, by their markup and by differencing pages of neighbouring URLs.

Every page becomes its lines of text (blocks), each marked by the markup it stands in: article,
chrome (menus, adverts, forms, comments and the like) or loose. Pages of a host are put in the
order of their URL paths; every page is paired with the neighbour whose path agrees longest, the
two are aligned by a longest common subsequence of all lines, and lines they share are deleted.
The markup checks what is left: chrome goes even if no neighbour shares it, and what an article
element holds comes back if it was shared, since two articles may quote the same line.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm.frames import BROADCAST_IDS, arrow_schema
from dimhistory.operators.numbering import dense_row_number

CHROME, LOOSE, ARTICLE = 0, 1, 2

#: Elements whose content is no markup, that hold no text of the page, or that stand alone.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "noscript"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
#: Elements that start and end a line.
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd",
    "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that make their content chrome, and words in class, id or role that do.
_CHROME_TAGS = {
    "head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "template",
    "object", "canvas", "audio", "video", "fieldset", "datalist", "search", "header",
}
_CHROME_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tions?|s)?|"
    r"banners?|cookies?|consent|gdpr|notices?|popups?|modals?|overlays?|newsletters?|subscribe|"
    r"subscription|signup|login|sidebars?|side|menus?|nav|navbar|navigation|navigationbar|"
    r"breadcrumbs?|pagination|pager|footers?|headers?|masthead|comments?|commentlist|disqus|respond|"
    r"replies|reply|reviews|share|sharing|social|related|recommended|recommendations|widgets?|"
    r"toolbar|skip|search|contentinfo|complementary|alert|toc|tags|byline)(?=$|[\s_-])",
    re.I,
)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?:>|\Z)",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]*))?", re.I)


def _is_chrome(name: str, tag: str, in_article: bool) -> bool:
    if name in _CHROME_TAGS:
        return not (name == "header" and in_article)
    if name in ("html", "body", "article", "main"):
        return False
    for mark in _MARKS.finditer(tag, len(name) + 1):
        value = (mark[2] or "").strip("\"'")
        if mark[1].lower() == "hidden" or _CHROME_WORDS.search(_CAMEL.sub("-", value)):
            return True
    return False


def page_lines(html: str | None) -> list[tuple[int, str]]:
    """The lines of a page in order, each with what it stands in.

    White space inside a line is one blank and character references are decoded; lines without
    text are left out. An element that never ends holds the rest of what holds it.
    """
    lines: list[tuple[int, str]] = []
    pieces: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # name, chrome, article: inherited
    held: dict[str, int] = {}
    source = html or ""
    at, size = 0, len(source)

    def end_line() -> None:
        if pieces:
            text = " ".join(markup.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                chrome, article = open_[-1][1:] if open_ else (False, False)
                lines.append((CHROME if chrome else ARTICLE if article else LOOSE, text))

    def hold(name: str, chrome: bool, article: bool) -> None:
        open_.append((name, chrome, article))
        held[name] = held.get(name, 0) + 1

    def close() -> str:
        name = open_.pop()[0]
        held[name] -= 1
        return name

    while at < size:
        token = _TOKEN.search(source, at)
        if not token:
            pieces.append(source[at:])
            break
        if token.start() > at:
            pieces.append(source[at : token.start()])
        tag, at = token[0], token.end()
        named = _NAME.match(tag)
        if not named:
            continue  # a comment or declaration
        name = named[1].lower()
        if name in _BLOCK:
            end_line()
        if tag[1] == "/":
            if held.get(name):
                end_line()
                while close() != name:
                    pass
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if name in _VOID or tag.endswith("/>") and name not in _BLOCK:
            continue
        chrome, article = open_[-1][1:] if open_ else (False, False)
        if name in ("body", "article", "main") and chrome and not _nested_comment(open_):
            # the bar above it was never closed
            while open_ and open_[-1][1]:
                close()
            chrome = False
        if name in _BLOCK or name in _CHROME_TAGS:
            chrome = chrome or _is_chrome(name, tag, article)
            if name == "p":
                if open_ and open_[-1][0] == "p":
                    close()
                chrome = chrome or (bool(open_) and open_[-1][1])
            hold(name, chrome, article or name in ("article", "main"))
        elif _is_chrome(name, tag, article):
            end_line()
            hold(name, True, article)
    end_line()
    return lines


def _nested_comment(open_: list[tuple[str, bool, bool]]) -> bool:
    """Whether the chrome that is open may itself hold articles, as comments and asides do."""
    first = next(name for name, chrome, _ in open_ if chrome)
    return first not in ("head", "nav", "header", "footer", "form", "menu", "button", "select")


# -- differencing ------------------------------------------------------------------------


def shared_lines(ours: list[int], theirs: list[int]) -> list[bool]:
    """Which of ``ours`` a longest common subsequence with ``theirs`` holds.

    Bit-parallel: one integer per line of ``ours`` records where the length grows.
    """
    out = [False] * len(ours)
    first = 0
    while first < min(len(ours), len(theirs)) and ours[first] == theirs[first]:
        out[first] = True
        first += 1
    a, b = ours[first:], theirs[first:]
    while a and b and a[-1] == b[-1]:
        out[first + len(a) - 1] = True
        a, b = a[:-1], b[:-1]
    places: dict[int, int] = {}
    for i, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << i
    full = (1 << len(b)) - 1
    flat, rows = full, []
    for line in a:
        met = flat & places.get(line, 0)
        flat = ((flat + met) | (flat - met)) & full
        rows.append(flat)
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            out[first + i] = True
            j -= 1
    return out


def _host(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def _path(url: Column) -> Column:
    path = F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(F.regexp_replace(path, r"(?:/|\.html?|/index\.html?)$", ""), F.lit(""))


def _parsed(pages: DataFrame) -> DataFrame:
    """``(row, page_id, url, host, path, lines, kinds, hashes)``, one row per page.

    ``lines`` are those that are no chrome. ``kinds`` has a byte and ``hashes`` a number for every
    line of the page.
    """
    narrow = pages.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        "url",
        _host(F.col("url")).alias("host"),
        _path(F.col("url")).alias("path"),
        "html",
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    ddl = (
        f"row long, page_id {kind}, url string, host string, path string, "
        "lines array<string>, kinds binary, hashes array<long>"
    )
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = []
                for page in part.column(5):
                    lines = page_lines(page.as_py())
                    texts = [text for kind, text in lines if kind != CHROME]
                    kinds = bytes(kind for kind, _ in lines)
                    hashes = np.array([xxhash.xxh64_intdigest(t) for _, t in lines], np.uint64)
                    out.append((texts, kinds, hashes.view(np.int64).tolist()))
                made = [
                    pa.array(c, f.type)
                    for c, f in zip(zip(*out, strict=True), list(schema)[5:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:5], *made], schema=schema)

    return narrow.mapInArrow(run, ddl)


def _common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)``: the main text of each whole page, empty if it has none.

    It is what differencing leaves of a page, without chrome, and with all lines of article and
    main elements; see :func:`kept_lines`. A null html counts as empty. Pages without url form one
    host. Repeated rows stay and are paired like any others; an empty table gives no rows; other
    columns are not read.
    """
    staging = Staging(pages.sparkSession)
    parsed = staging.write(_parsed(pages), "lines", compression="zstd")
    # only pages that differencing takes lines from meet their lines again
    cut = staging.write(_differenced(parsed, staging), "cut")
    few = cut.count() <= BROADCAST_IDS
    met = parsed.join(F.broadcast(cut) if few else cut, "row", "left")
    own = F.transform(
        F.filter(F.arrays_zip("lines", "kept"), lambda x: x["kept"]), lambda x: x["lines"]
    )
    left = F.when(F.col("kept").isNull(), F.col("lines")).otherwise(own)
    return met.select("page_id", "url", F.array_join(left, " ").alias("text"))


def kept_lines(kinds: bytes, shared: list[bool] | None) -> list[bool]:
    """Which of a page's lines that are no chrome are its text.

    ``shared`` says which of all its lines differencing deletes; it is None without a neighbour.
    An article's lines come back. Loose ones stay if they are not shared; if all of a page without
    article are, it is a copy of its pair, differencing tells nothing, and they stay. Without a
    neighbour, they are the text of pages without article only.
    """
    article = ARTICLE in kinds
    if shared is None:
        return [kind == ARTICLE or not article for kind in kinds if kind != CHROME]
    kept = [
        kind == ARTICLE or not deleted
        for kind, deleted in zip(kinds, shared, strict=True)
        if kind != CHROME
    ]
    return kept if article or any(kept) else [True] * len(kept)


def _differenced(parsed: DataFrame, staging: Staging) -> DataFrame:
    """``(row, kept)`` of each page that loses lines to its pair: which of its ``lines`` stay.

    Every page is aligned with its pair; of the others all ``lines`` stay.
    """
    narrow = parsed.select("host", "path", "row", "kinds", "hashes")
    placed = staging.write(
        dense_row_number(narrow, ["host", "path", "row"], "at", staging, unique=True), "order"
    )
    paired = placed.select("host", "path", "row", "kinds", "hashes", "at")
    for name, step in (("before", 1), ("after", -1)):
        other = placed.select(
            F.col("host").alias("h"), (F.col("at") + step).alias("t"), F.struct("path", "hashes").alias(name)
        )
        met = (F.col("at") == F.col("t")) & (F.col("host") == F.col("h"))
        paired = paired.join(other, met, "left").drop("t", "h")
    ddl = "row long, kept array<boolean>"
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for one in batch.to_pylist():
                pairs = [p for p in (one["before"], one["after"]) if p]
                best = max(pairs, key=lambda p: _common_prefix(one["path"], p["path"]), default=None)
                shared = shared_lines(one["hashes"], best["hashes"]) if best else None
                kept = kept_lines(one["kinds"], shared)
                if not all(kept):
                    rows.append(one["row"])
                    out.append(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, schema[0].type), pa.array(out, schema[1].type)], schema=schema
            )

    return paired.select("row", "path", "kinds", "hashes", "before", "after").mapInArrow(run, ddl)
