"""Main text of web pages: what markup leaves open is settled by differencing with the nearest URL."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clustertrace.llm.shared import stored, text_or_empty
from clustertrace.llm.url_filter import url_host, url_path

#: What markup says of a line.
CHROME, OPEN, ARTICLE = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)",
    re.S,
)
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are never the article's text, and those that may be wrongly so called by a class.
_CHROME_TAGS = set(
    "nav aside footer form button select option optgroup input fieldset dialog menu menuitem head object canvas "
    "video audio applet datalist".split()
)
_CHROME_NAMES = set(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead topbar toolbar header footer sidebar sidenav "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments disqus respond reply replies pagination pager skip copyright".split()
)
_CHROME_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
_ROOTS = {"html", "body", "main", "article"}
_ONE_PARAGRAPH = set(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
    "table ul".split()
)
#: Elements inside which a paragraph that is open outside them isn't closed.
_SCOPES = "applet button caption html marquee object table td template th".split()


def _chrome_by_attributes(tag: str, text: str, in_article: bool) -> bool:
    if not text or tag in _ROOTS:
        return False
    names: list[str] = []
    for name, a, b, c in _ATTRIBUTE.findall(text):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            names += [x.lower() for x in _NAME_PART.findall(value)]
        elif name == "role" and value.lower() in _CHROME_ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    found = _CHROME_NAMES.intersection(names)
    return bool(found - {"header"} if in_article else found)


def _tag_end(source: str, at: int, last: dict[str, int]) -> int:
    """Where the attributes that begin at ``at`` end: at the next ``>`` outside quotes, else at the page's end.

    ``last`` has the last place of either quote: one that isn't closed any more is a letter like others, so
    nothing is read twice.
    """
    while stop := _STOP.search(source, at):
        at, sign = stop.start(), stop[0]
        if sign == ">":
            return at
        at = source.index(sign, at + 1) + 1 if at < last[sign] else at + 1
    return len(source)


def page_lines(source: str) -> list[tuple[str, int]]:
    """The lines of a page, one per block with text, and what markup says of each.

    Character references are decoded and each run of white space is one space. An article that opens
    inside a block which only its class calls chrome ends that block's claim, as such blocks are
    often left open. A tag that isn't closed ends with the page and is no text. The time is in
    proportion to the page's length, whatever its markup.
    """
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    # Open elements, each with the state that holds inside it: whether a chrome element is open,
    # whether a block called chrome by its class is, and whether an article is.
    stack: list[tuple[str, tuple[bool, bool, bool]]] = [("", (False, False, False))]
    places: dict[str, list[int]] = {}  # where in the stack a tag's open elements are
    last = {sign: source.rfind(sign) for sign in "\"'"}
    kind = OPEN

    def close(k: int) -> None:
        nonlocal kind
        for tag, _ in stack[k:]:
            places[tag].pop()
        del stack[k:]
        by_tag, by_class, article = stack[-1][1]
        kind = CHROME if by_tag or by_class else ARTICLE if article else OPEN

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append((text, kind))

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if found is None:
            parts.append(source[at:])
            break
        if found.start() > at:
            parts.append(source[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        shut = _tag_end(source, at, last)
        attributes = source[at:shut]
        at = min(shut + 1, end)
        if found[1]:
            if tag not in _INLINE or kind == CHROME:
                flush()
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in _RAW:
            # Their content is no markup, up to their end tag.
            if not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = over.end() if over else end
            continue
        if tag not in _INLINE:
            flush()
        if tag in _VOID or attributes.endswith("/") and tag not in _ROOTS | _CHROME_TAGS | {"div", "p", "span"}:
            continue
        if tag in _ONE_PARAGRAPH and places.get("p"):
            scope = max((places[t][-1] for t in _SCOPES if places.get(t)), default=0)
            if places["p"][-1] > scope:
                close(places["p"][-1])
        by_tag, by_class, article = stack[-1][1]
        before = kind
        if tag in ("article", "main"):
            by_class, article = False, True
        elif tag in _CHROME_TAGS or tag == "header" and not article:
            by_tag = True
        elif _chrome_by_attributes(tag, attributes, article):
            by_class = True
        kind = CHROME if by_tag or by_class else ARTICLE if article else OPEN
        if kind != before and tag in _INLINE:
            after, kind = kind, before
            flush()
            kind = after
        stack.append((tag, (by_tag, by_class, article)))
        places.setdefault(tag, []).append(len(stack) - 1)
    flush()
    return lines


def common_lines(a: list[int], b: list[int], most_bits: int = 400_000_000) -> np.ndarray:
    """Which entries of ``a`` are in a longest common subsequence of ``a`` and ``b``.

    Rows of the table are bit vectors; where all of them would take more than ``most_bits``, ``a`` is
    halved and ``b`` cut where the two parts' lengths add up best.
    """
    out = np.zeros(len(a), bool)
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    out[:first] = True
    out[len(a) - last :] = True
    in_a, in_b = set(a[first : len(a) - last]), set(b[first : len(b) - last])
    rows = [k for k in range(first, len(a) - last) if a[k] in in_b]
    right = [x for x in b[first : len(b) - last] if x in in_a]
    left = [a[k] for k in rows]
    if not left:
        return out
    out[np.array(rows)[_subsequence(left, right, most_bits)]] = True
    return out


def _bit_rows(a: list[int], b: list[int]) -> Iterator[int]:
    """For each prefix of ``a`` a number whose bit j is 0 where entry j of ``b`` lengthens the subsequence."""
    at: dict[int, int] = {}
    for k, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        use = row & at.get(x, 0)
        row = ((row + use) | (row - use)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _bit_rows(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.append(0, np.cumsum(bits[: len(b)] == 0))


def _subsequence(a: list[int], b: list[int], most_bits: int) -> np.ndarray:
    if len(a) * len(b) > most_bits and len(a) > 1:
        half = len(a) // 2
        total = _lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(total.argmax())
        return np.concatenate([_subsequence(a[:half], b[:cut], most_bits), _subsequence(a[half:], b[cut:], most_bits)])
    out = np.zeros(len(a), bool)
    rows = list(_bit_rows(a, b))
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out[i] = True
    return out


def same_article(shared: np.ndarray, sizes: list[int], alike: float) -> bool:
    """Whether the shared lines hold ``alike`` of the characters outside chrome."""
    weight = np.abs(np.array(sizes))
    return bool(weight[shared].sum() >= alike * weight.sum())


def shared_lines(
    own: list[int], sizes: list[int], others: list[tuple[str, list[int]]], path: str, alike: float
) -> list[int] | None:
    """Positions of the open lines that a page shares with its nearest page.

    ``sizes`` are the lines' lengths, negative in an article and 0 in chrome. The others are tried in
    the order of the path they have in common, then as given. One that is the same article (see
    ``same_article``) is passed over; None if all are.
    """

    def near(other: str) -> int:
        n = 0
        while n < min(len(other), len(path)) and other[n] == path[n]:
            n += 1
        return n

    for _, lines in sorted(others, key=lambda x: -near(x[0])):
        shared = common_lines(own, lines)
        if not same_article(shared, sizes, alike):
            return [k for k in np.flatnonzero(shared).tolist() if sizes[k] > 0]
    return None if others else []


def _settle(batches: Iterator[pa.RecordBatch], partners: list[str], alike: float) -> Iterator[pa.RecordBatch]:
    """Per page the positions that go, and whether it has partners but all are its own article; the others are left out."""
    for batch in batches:
        keys, hosts, gone, passed = [], [], [], []
        for row in batch.to_pylist():
            others = [(row[c]["path"], row[c]["lines"]) for c in partners if row[c] is not None]
            found = shared_lines(row["lines"], row["sizes"], others, row["path"], alike)
            if found != []:
                keys.append(row["key"])
                hosts.append(row["host"])
                gone.append(found or [])
                passed.append(found is None)
        columns = {"key": (keys, pa.binary()), "host": (hosts, pa.string()), "gone": (gone, pa.list_(pa.int32())), "passed": (passed, pa.bool_())}
        yield pa.RecordBatch.from_pydict({name: pa.array(values, kind) for name, (values, kind) in columns.items()})


_SETTLED = "key binary, host string, gone array<int>, passed boolean"


def _beyond_runs(near: DataFrame, passed: DataFrame, alike: float) -> DataFrame:
    """For each page of ``passed`` the last page before its run and the first one behind it, as ``before`` and ``behind``.

    A run is a stretch of a host's pages, in the order of paths, each the same article as the one before it.
    ``near`` has all pages with their slice and ``p1``, the page before. Runs are followed within slices; a row
    per slice tells the other slices of the host where runs begin in it.
    """

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["lines", "sizes", "p1"]).to_pylist()
            begins = [
                r["p1"] is None or not same_article(common_lines(r["lines"], r["p1"]["lines"]), r["sizes"], alike) for r in rows
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(begins, pa.bool_())], names=[*batch.schema.names, "begins"])

    pages = near.select("key", "host", "slice", "path", "lines", "sizes", "p1")
    pages = pages.join(passed.select("host").distinct(), "host", "left_semi").select(pages.columns)
    page = "struct<path: string, lines: array<bigint>>"
    schema = f"key binary, host string, slice int, path string, lines array<bigint>, sizes array<int>, p1 {page}"
    runs = stored(pages.mapInArrow(begun, f"{schema}, begins boolean"), "runs")
    order = F.when(F.col("begins"), F.struct("path", "key"))
    # Wrapped, so that a run that nothing precedes is told from a page that begins none.
    ahead, own = F.struct(F.col("p1").alias("page")), F.struct("path", "lines")
    slices = runs.groupBy("host", "slice").agg(F.max_by(ahead, order).alias("ahead"), F.min_by(own, order).alias("first"))
    earlier = Window.partitionBy("host").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("host").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "host",
        "slice",
        F.last("ahead", ignorenulls=True).over(earlier).alias("ahead_of_slice"),
        F.last("first", ignorenulls=True).over(later).alias("behind_slice"),
    )
    so_far = Window.partitionBy("host", "slice").orderBy("path", "key").rowsBetween(Window.unboundedPreceding, 0)
    to_come = Window.partitionBy("host", "slice").orderBy(F.desc("path"), F.desc("key")).rowsBetween(Window.unboundedPreceding, -1)
    found = runs.select(
        "*",
        F.last(F.when(F.col("begins"), ahead), ignorenulls=True).over(so_far).alias("ahead"),
        F.last(F.when(F.col("begins"), own), ignorenulls=True).over(to_come).alias("next"),
    )
    found = found.join(passed.select("key"), "key", "left_semi").join(slices, ["host", "slice"], "left")
    return found.select(
        "key",
        "host",
        "path",
        "lines",
        "sizes",
        F.coalesce("ahead", "ahead_of_slice")["page"].alias("before"),
        F.coalesce("next", "behind_slice").alias("behind"),
    )


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    alike: float = 0.8,
    counts: bool = False,
) -> DataFrame:
    """Per page the id and URL columns and ``text``, its main text.

    With ``counts`` also how many lines each rule settled: ``n_chrome`` and ``n_article`` by markup,
    ``n_shared`` deleted by differencing, and ``n_open`` kept because they are not shared.

    A page is cut into lines, one per block. Markup decides first: lines in navigation, asides,
    footers, page headers, forms, hidden parts and blocks whose class, id or role names such a part
    or adverts, notices or comments are dropped; the other lines of an ``article`` or ``main`` stay,
    also where pages share them. Lines of which markup says neither are settled by differencing: a
    page is paired with the page of its host that is nearest by URL path (of the two before and the
    two after in the order of paths, the one with the longest common path that isn't the same
    article, see ``alike``), their lines are aligned by longest common subsequence, and shared open
    lines are deleted. Where all four are the same article, the pages next to the whole run of it are
    tried, however far they are. A page without another article on its host keeps its open lines, as does
    one that is alike both pages next to its run. Kept lines are joined by spaces.

    Only line hashes are sorted, in ranges of host and path, so a hot host spans many partitions;
    the ends of the ranges are matched by a second, small window. Pages with equal URL and HTML are
    one there. Then the pages are read again, and only pages with deletions need a row of the join.

    NULL and empty pages and an empty table have no text; long pages are read whole, in time in proportion
    to their length but for the alignment, which grows with the product of two pages' lines. NULL URLs and those without a host form one host of
    their own. Rows with a repeated or NULL id are treated one by one.
    """
    url, source = (text_or_empty(F.col(f"`{c}`")) for c in (url_col, html_col))
    key = F.unhex(F.md5(F.concat(F.length(url).cast("string"), F.lit(":"), url, source).cast("binary")))
    rows = pages.select(
        key.alias("key"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        source.alias("html"),
        url_host(url).alias("host"),
        url_path(url).alias("path"),
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = [], []
            for source in batch.column(3).to_pylist():
                lines = page_lines(source)
                hashes.append([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, _ in lines])
                sizes.append([{OPEN: 1, ARTICLE: -1, CHROME: 0}[kind] * len(t) for t, kind in lines])
            arrays = [*batch.columns[:3], pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "host", "path", "lines", "sizes"])

    keyed = rows.select("key", "host", "path", "html").mapInArrow(
        hashed, "key binary, host string, path string, lines array<bigint>, sizes array<int>"
    )
    ranged = stored(
        keyed.dropDuplicates(["key"]).repartitionByRange("host", "path", "key").withColumn("slice", F.spark_partition_id()),
        "ranged",
    )
    own = F.struct("path", "lines")
    within = Window.partitionBy("host", "slice").orderBy("path", "key")
    steps = {"p1": (F.lag, 1), "n1": (F.lead, 1), "p2": (F.lag, 2), "n2": (F.lead, 2)}
    near = ranged.select(
        "*",
        *(f(own, n).over(within).alias(c) for c, (f, n) in steps.items()),
        F.row_number().over(within).alias("from_start"),
        F.count(F.lit(1)).over(Window.partitionBy("host", "slice")).alias("in_slice"),
    )
    ends = near.filter((F.col("from_start") <= 2) | (F.col("from_start") > F.col("in_slice") - 2))
    across = Window.partitionBy("host").orderBy("path", "key")
    ends = ends.select("key", *(f(own, n).over(across).alias(f"end_{c}") for c, (f, n) in steps.items()))
    near = near.join(ends, "key", "left")
    # What a slice has itself comes first; beyond its ends the neighbours of the ends hold.
    before, after = F.col("from_start"), F.col("in_slice") - F.col("from_start") + 1
    filled = {c: F.coalesce(c, F.when((before if c[0] == "p" else after) <= int(c[1]), F.col(f"end_{c}"))) for c in steps}
    near = near.select("key", "host", "slice", "path", "lines", "sizes", *(filled[c].alias(c) for c in steps))
    undecided = near.filter(F.exists("sizes", lambda x: x > 0)).drop("slice")
    settled = stored(undecided.mapInArrow(lambda b: _settle(b, list(steps), alike), _SETTLED), "shared-lines")
    gone, passed = settled.filter("NOT passed").select("key", "gone"), settled.filter("passed")
    if not passed.isEmpty():
        further = _beyond_runs(near, passed, alike).mapInArrow(lambda b: _settle(b, ["before", "behind"], alike), _SETTLED)
        gone = gone.unionByName(stored(further.filter("NOT passed").select("key", "gone"), "shared-further"))

    settled_by = ("n_chrome", "n_article", "n_shared", "n_open")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for source, dropped in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                without = set(dropped or ())
                lines = page_lines(source)
                texts.append(" ".join(t for k, (t, kind) in enumerate(lines) if kind != CHROME and k not in without))
                kinds = np.bincount([kind for _, kind in lines], minlength=3)
                numbers.append((kinds[CHROME], kinds[ARTICLE], len(without), kinds[OPEN] - len(without)))
            arrays = [*batch.columns[:2], pa.array(texts, pa.string())]
            if counts:
                arrays += [pa.array(column, pa.int64()) for column in np.array(numbers, np.int64).reshape(-1, 4).T]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "url", "text", *settled_by][: len(arrays)])

    kind = pages.schema[id_col].dataType.simpleString()
    out = rows.join(gone, "key", "left").select("id", F.col("url").cast("string"), "html", "gone")
    more = "".join(f", {c} bigint" for c in settled_by) if counts else ""
    out = out.mapInArrow(extracted, f"id {kind}, url string, text string{more}")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
