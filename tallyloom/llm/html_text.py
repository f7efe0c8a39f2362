"""HTML extraction: the mark-up names what it can, nearest-URL page differencing finds the rest.

Lines are held against those of the page of the same host whose path is nearest: they are aligned by longest common
subsequence, and shared ones, the site's furniture, are deleted.  A page whose mark-up holds an article (or main) element
vouches for its text: of its lines those go that are shared so and stand in most of the host's articles too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_batches
from tallyloom.llm.url_filter import url_parts
from tallyloom.scale import written

TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)"""
                 r"""|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)(?P<close>>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
          "object", "map", "math", "semantics", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "msup", "msub", "msubsup", "munder",
          "mover", "munderover", "mmultiscripts", "mprescripts", "mstyle", "mpadded", "mphantom", "merror", "menclose", "mfenced", "mtable", "mtr", "mtd"}
SPACED = {"br", "td", "th", "hr", "img", "wbr"}  # white space inside a block; wbr is none
FURNITURE = {"head", "nav", "aside", "footer", "form", "button", "select", "option", "datalist", "fieldset", "menu", "dialog", "template",
             "embed", "applet", "svg", "canvas", "audio", "video", "annotation", "annotation-xml"} | RAW
UNSEEN = {"template", "svg", "canvas", "audio", "video", "select", "datalist", "annotation", "annotation-xml"}  # furniture whatever they hold
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar",
         "toolbar", "tablist", "status"}
# words in class or id that name furniture, as the first or last word of a name
NAMED = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "sponsors", "promo",
         "promotion", "promoted", "banner", "banners", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "popup",
         "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "signin", "nav", "navbar", "navigation", "menu", "menus",
         "breadcrumb", "breadcrumbs", "sidebar", "sidebars", "aside", "widget", "widgets", "related", "recommended", "recommendations", "share",
         "sharing", "social", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "footer", "masthead", "topbar",
         "toolbar", "pagination", "pager", "copyright", "disclaimer", "search", "searchbox", "skip", "hidden", "paywall", "alert",
         "alerts", "announcement", "announcements", "infobar", "toast", "interstitial", "lightbox", "responses", "feedback", "adsense", "adslot",
         "advertorial", "dropdown", "submenu", "topnav", "subnav", "sidenav", "side-bar", "top-bar", "site-footer", "page-footer"}
# these name it only if they are the whole name, or the box they stand in is named too
AMBIGUOUS = {"hidden", "search", "notice", "notices", "alert", "alerts", "skip", "overlay", "modal", "feedback", "responses", "reply", "replies", "respond",
             "copyright", "share", "sharing", "social", "promotion", "promoted", "subscription", "notification", "disclaimer", "announcement", "announcements"}
BOXES = {"box", "bar", "form", "field", "input", "button", "buttons", "icons", "links", "wrapper", "container", "widget", "block", "panel", "dialog", "link"}
# inside an article a name counts only if all its words are of these or say no more than where and in what kind of box something
# stands; any other name may be the article's own
INSIDE = NAMED - AMBIGUOUS - {"menu", "menus", "nav", "navigation", "search", "searchbox", "widget", "widgets", "banner", "banners", "aside", "footer", "masthead", "promo",
                              "related", "comment", "hidden", "dropdown", "login", "signin", "signup", "paywall"}
PLACES = BOXES | {"user", "users", "reader", "readers", "post", "article", "section", "area", "list", "thread", "slot", "unit", "top", "bottom", "inline", "site", "main", "left",
                  "right", "inner", "outer", "header", "content", "group", "item", "items"}
# a name that starts or ends so tells what its page or element has, or how it is shown
STARTS = {"has", "have", "no", "not", "non", "with", "without", "is", "overflow", "hide", "show", "backface", "visually"}
ENDS = {"open", "opened", "closed", "layout", "enabled", "disabled", "active", "on", "off", "none", "visible", "page", "result", "results"}
HEADERS = {"header", "heading-bar", "siteheader", "site-header", "pageheader", "page-header"}
CONTENT = {"article", "main"}
COPY_SHARE = 0.8  # a neighbour that shares so much of a page's text may be a copy of it, not its frame
FEWEST_TITLES = 10  # a line that fewer articles of a host hold is not the site's
FEW_WORDS = 5  # what two pages do not share is no text of its own below so many different words


def _attributes(rest: str) -> dict[str, str]:
    return {k.lower(): unescape(a or b or c) for k, a, b, c in reversed(ATTRIBUTE.findall(rest))}


def _named(text: str, words: set[str]) -> bool:
    """Whether one of the names in a class or id is among `words`, or starts or ends with one of them."""
    for token in text.split():
        whole = token.lower()
        if whole in words:
            return True
        parts = _parts(token)
        if not parts or (len(parts) > 1 and (parts[0] in STARTS or parts[-1] in ENDS)):
            continue
        if any(x in words and (x not in AMBIGUOUS or len(parts) == 1 or parts[-1] in BOXES) for x in (parts[0], parts[-1])):
            return True
    return False


def _parts(token: str) -> list[str]:
    return [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if x]


def _all_furniture(token: str) -> bool:
    """Whether a name says furniture and nothing else."""
    parts = [token.lower()] if token.lower() in INSIDE else _parts(token)
    return any(x in INSIDE for x in parts) and all(x in INSIDE or x in PLACES for x in parts)


def _is_hidden(rest: str) -> bool:
    at = _attributes(rest)
    return "hidden" in at or at.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", ""), re.I))


def _is_furniture(name: str, rest: str, in_content: bool) -> bool:
    if name in FURNITURE:
        return True
    if name == "header":  # an article's own header holds its title
        return not in_content
    if not rest.strip() or name in ("html", "body"):
        return False
    if _is_hidden(rest):
        return True
    at = _attributes(rest)
    if at.get("role", "").lower() in ROLES:
        return True
    names = at.get("class", "") + " " + at.get("id", "")
    if in_content and name not in CONTENT:
        return any(_all_furniture(token) for token in names.split())
    if name in CONTENT and not _named(names, {"comment", "comments", "reply", "related", "ad", "ads", "sponsored", "promo", "teaser"}):
        return False
    return _named(names, NAMED) or _named(names, HEADERS)


def page_blocks(html: str | None) -> tuple[list[str], bool]:
    """The text blocks of a page without its named furniture, and whether a content element vouches for them.

    A block is what stands between the starts and ends of block-level elements; character references are
    decoded, white space (line breaks and table cells too) is one space.  If the page has article or main elements, only
    what they hold counts: the articles', unless main holds more than twice as much.  Unclosed elements end with their parent; a tag or comment cut off at the page's end is dropped.
    An element that is furniture by name but holds an article or main, and is not hidden, is no furniture if the page has no other
    content element or twice as much text with what it holds.
    """
    holders: set[int] = set()
    found, vouched = _parsed(html or "", frozenset(), holders)
    tried: set[int] = set()
    while holders - tried:  # what is opened may hold another such element
        tried |= holders
        opened, by_mark_up = _parsed(html or "", frozenset(tried), holders)
        if by_mark_up and (not vouched or sum(map(len, opened)) > 2 * sum(map(len, found))):
            found, vouched = opened, True
    return found, vouched


def _parsed(html: str, spared: frozenset[int], holders: set[int]) -> tuple[list[str], bool]:
    """See `page_blocks`; elements whose tags start at `spared` are no furniture.

    Adds to `holders` the places of those that are skipped outside of content though they hold an article or main.
    """
    stack: list[str] = []
    standing: Counter[str] = Counter()  # names in the stack, so that unclosed elements do not cost a search each
    skip_at = None  # depth of the furniture element that is open
    skipped_from = None  # and where its tag starts, if it may be opened
    content: list[int] = []  # depths of open content elements
    rank = 0  # what the best open content element is: 2 article, 1 main, 0 none
    blocks: list[tuple[str, int]] = []
    piece: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(piece)).split()) if piece else ""
        if text:
            blocks.append((text, rank))
        piece.clear()

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        if m is None:
            if skip_at is None:
                piece.append(html[at:])
            break
        if skip_at is None and m.start() > at:
            piece.append(html[at:m.start()])
        at = m.end()
        if m["data"] is not None and skip_at is None:
            piece.append(m["data"].replace("&", "&amp;"))
        name = m["name"]
        if name is None:
            continue
        if not m["close"]:
            break  # cut off inside a tag
        name = name.lower()
        if m["end"]:
            if name == "br" and skip_at is None:
                piece.append(" ")
            if not standing[name]:
                if name == "p" and skip_at is None:
                    flush()
                continue
            while stack:
                top = stack.pop()
                standing[top] -= 1
                if skip_at is not None and len(stack) <= skip_at:
                    skip_at = None
                elif skip_at is None and top not in INLINE:
                    if top in SPACED:
                        piece.append(" ")
                    else:
                        flush()
                while content and content[-1] >= len(stack):
                    flush()
                    content.pop()
                    rank = max([2 if stack[d] == "article" else 1 for d in content], default=0)
                if top == name:
                    break
            continue
        if skip_at is None:
            if name in SPACED:
                if name != "wbr":
                    piece.append(" ")
            elif name not in INLINE:
                flush()
        if name in RAW:
            end = RAW_END[name].search(html, at)
            at = end.start() if end else size
            stack.append(name)
            standing[name] += 1
            if skip_at is None:
                skip_at = len(stack) - 1
            continue
        if name in VOID or (m["rest"].endswith("/") and name in ("path", "rect", "circle", "use", "line")):
            continue
        if name == "p" and standing["p"] and skip_at is None:
            # a paragraph ends the one before, unless something else was opened inside
            while stack and standing["p"] and (stack[-1] in INLINE or stack[-1] == "p"):
                top = stack.pop()
                standing[top] -= 1
                if top == "p":
                    break
        elif name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1] == name:
            standing[stack.pop()] -= 1
        stack.append(name)
        standing[name] += 1
        if skip_at is not None and skipped_from is not None and name in CONTENT and not _is_furniture(name, m["rest"], False):
            holders.add(skipped_from)
        if skip_at is None:
            if m.start() not in spared and _is_furniture(name, m["rest"], bool(content)):
                flush()
                skip_at = len(stack) - 1
                skipped_from = m.start() if not content and name not in UNSEEN and not _is_hidden(m["rest"]) else None
            elif name in CONTENT or (m["rest"] and re.search(r"""role\s*=\s*["']?main\b|articlebody""", m["rest"], re.I)):
                flush()
                content.append(len(stack) - 1)
                rank = max(rank, 2 if name == "article" else 1)
    flush()
    sizes = [sum(len(t) for t, r in blocks if r >= best) for best in (0, 1, 2)]
    if not sizes[1]:
        return [t for t, _ in blocks], False
    # an article element that holds less than half of the main element is a teaser in it
    best = 2 if 2 * sizes[2] >= sizes[1] else 1
    return [t for t, r in blocks if r >= best], True


def common_positions(a: Sequence, b: Sequence) -> list[int]:
    """Positions in `a` of a longest common subsequence of `a` and `b`.

    Bit-parallel: a row of the table is one number with a bit per element of `b`.  Every k-th row is kept and the
    rows between are made again on the way back, so memory grows with the square root of the lines.
    """
    in_a, in_b = set(a), set(b)
    own = [(k, x) for k, x in enumerate(a) if x in in_b]
    other = [x for x in b if x in in_a]
    if not own or not other:
        return []
    places: dict = {}
    for k, x in enumerate(other):
        places[x] = places.get(x, 0) | (1 << k)
    full = (1 << len(other)) - 1
    step = max(1, int(len(own) ** 0.5))

    def after(row: int, x) -> int:
        u = row & places[x]
        return ((row + u) | (row - u)) & full

    kept, row = [full], full
    for k, (_, x) in enumerate(own, 1):
        row = after(row, x)
        if k % step == 0:
            kept.append(row)
    found, i, j = [], len(own), len(other)
    lines: dict[int, int] = {}

    def line(k: int) -> int:
        if k not in lines:
            lines.clear()
            base = k // step
            now = kept[base]
            lines[base * step] = now
            for r in range(base * step + 1, min(len(own), (base + 1) * step) + 1):
                now = after(now, own[r - 1][1])
                lines[r] = now
        return lines[k]

    while i and j:
        if line(i) >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or line(i) >> (j - 1) & 1:
                found.append(own[i][0])
                j -= 1
    return found[::-1]


def _words(line: str) -> list[int]:
    """The hashes of a line's distinct words, digits alike."""
    import xxhash

    hashes = {xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) - (1 << 31) for w in re.sub(r"[0-9]+", "0", line.lower()).split()}
    return sorted(hashes)


def _frame_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line hashes and sizes of each page, and words where no content element vouches for it; `digest` is the same for the same lines."""
    import xxhash

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("row", "host", "path", "html")]
        for row, host, path, html in zip(*columns, strict=True):
            blocks, vouched = page_blocks(html)
            if blocks and host:
                hashes = [xxhash.xxh64_intdigest(b.encode("utf-8", "surrogatepass")) - (1 << 63) for b in blocks]
                words = [] if vouched else [_words(b) for b in blocks]
                out.append((row, host, path, vouched, xxhash.xxh128_digest(np.array(hashes, dtype="int64").tobytes()), hashes, [len(b) for b in blocks], words))
        made = list(zip(*out, strict=True)) or [[]] * 8
        kinds = [pa.binary(), pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(made, kinds, strict=True)],
                                         names=["row", "host", "path", "vouched", "digest", "hashes", "sizes", "words"])


def _is_copy(own: dict, other: dict, found: list[int]) -> bool:
    """Whether two pages that share the lines `found` of `own` are copies, rather than two texts in one frame.

    Copies share COPY_SHARE of the text, and what is left is the same words too (digits aside), or nothing, or a few words.
    Of pages with an article, whose frame is gone already, the share alone tells.
    """
    if sum(own["sizes"][k] for k in found) < COPY_SHARE * sum(own["sizes"]):
        return False
    shared = set(found)
    theirs = set(common_positions(other["hashes"], own["hashes"]))
    left = {w for k, words in enumerate(own["words"]) if k not in shared for w in words}
    right = {w for k, words in enumerate(other["words"]) if k not in theirs for w in words}
    return min(len(left), len(right)) < FEW_WORDS or 2 * len(left & right) >= len(left | right)


def _nearness(path: str, other: str) -> int:
    n = 0
    for x, y in zip(path, other, strict=False):
        if x != y:
            break
        n += 1
    return n


PAGE = ["slice", "rank", "host", "path", "digest", "hashes", "sizes", "words", "common"]
PAGE_TYPES = "slice int, rank int, host string, path string, digest binary, hashes array<long>, sizes array<int>, words array<array<int>>, common array<long>"
PAGE_ARROW = pa.schema([("slice", pa.int32()), ("rank", pa.int32()), ("host", pa.string()), ("path", pa.string()), ("digest", pa.binary()),
                        ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("words", pa.list_(pa.list_(pa.int32()))), ("common", pa.list_(pa.int64()))])
LAST, DIFFERENT = -1, -2  # ranks of the pages that a slice hands on: its last one, and the nearest before it that is no copy of it


def _handed_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each slice alone hands on; its rows come last page first.  `whole` tells that all are of one host."""
    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    out: list[dict] = []
    last = different = None
    whole = True

    def close() -> None:
        out.append(last | {"rank": LAST, "whole": whole})
        if different is not None:
            out.append(different | {"rank": DIFFERENT, "whole": whole})

    for r in rows():
        if last is None or r["slice"] != last["slice"]:
            if last is not None:
                close()
            last, different, whole = r, None, True
        elif r["host"] != last["host"]:
            whole = False
        elif different is None and not _is_copy(last, r, common_positions(last["hashes"], r["hashes"])):
            different = r
    if last is not None:
        close()
    yield pa.RecordBatch.from_pylist(out, schema=PAGE_ARROW.append(pa.field("whole", pa.bool_())))


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each slice receives, as pages with the slice's number: a row or two a slice, in the order of the walk."""
    slices: dict[int, dict] = {}
    for batch in batches:
        for r in batch.to_pylist():
            slices.setdefault(r["slice"], {})[r["rank"]] = r
    out: list[dict] = []
    state: dict = {}
    for number, own in slices.items():
        out += [page | {"slice": number, "rank": rank} for rank, page in state.items()]
        last = own[LAST]
        if DIFFERENT not in own and last["whole"] and state and state[LAST]["host"] == last["host"]:
            for rank in (LAST, DIFFERENT):  # the run of copies goes on from slices before
                other = state.get(rank)
                if other is not None and not _is_copy(last, other, common_positions(last["hashes"], other["hashes"])):
                    own[DIFFERENT] = other
                    break
        state = own
    yield pa.RecordBatch.from_pylist([{k: r[k] for k in PAGE} for r in out], schema=PAGE_ARROW)


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, nearness, gone) for pages that have a neighbour on the side the walk comes from."""
    number = last = different = None
    for batch in batches:
        out: list[dict] = []
        for r in batch.to_pylist():
            if r["slice"] != number:
                number, last, different = r["slice"], None, None
            if r["rank"] == DIFFERENT:
                different = r
                continue
            if r["rank"] == LAST:
                last = r
                continue
            if last is None or last["host"] != r["host"]:
                last, different = r, None
                continue
            for other in (last, different):
                if other is None:
                    continue
                found = common_positions(r["hashes"], other["hashes"])
                if not _is_copy(r, other, found):
                    if r["common"] is not None:
                        common = set(r["common"])
                        found = [k for k in found if r["hashes"][k] in common]
                    out.append({"host": r["host"], "digest": r["digest"], "nearness": _nearness(r["path"], other["path"]), "gone": found})
                    different = other
                    break
            last = r
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("host", pa.string()), ("digest", pa.binary()), ("nearness", pa.int32()), ("gone", pa.list_(pa.int32()))]))


def common_lines(lines: DataFrame) -> DataFrame:
    """(host, digest, common): the lines of a page that most articles of its host hold, for pages that have any.

    Pages are counted by their first line, so copies of an article, near ones too, count once; FEWEST_TITLES at least, and
    half of the host's.  Counting is distinct rows first and sums after, so no host's pages meet in a task.
    """
    first = F.get("hashes", 0).alias("first")
    titles = written(lines.select("host", first).distinct().groupBy("host").agg(F.count("*").alias("of")))
    held = lines.select("host", first, F.explode("hashes").alias("line")).distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    often = written(written(held.where(F.col("n") >= FEWEST_TITLES)).join(titles, "host").where("2 * n >= of").select("host", "line"))
    own = lines.select("host", "digest", F.explode("hashes").alias("line"))
    return written(own.join(often, ["host", "line"]).groupBy("host", "digest").agg(F.collect_set("line").alias("common")))


def shared_line_positions(lines: DataFrame) -> DataFrame:
    """(gone_row, gone): the positions to delete, for pages of `lines` (row, host, path, vouched, digest, hashes, sizes, words) that have any.

    Pages of a host with the same lines are one.  They are range-sorted by host and path and written with the number of
    their range, then walked in both directions: a page is held against the one before it, or if that is a copy, against the nearest
    different one, which the walk carries along and hands on from range to range.  Of the two sides the page
    with the longer common path start counts.  Pages with an article (`vouched`) are walked among themselves, those that have
    lines common on their host (see `common_lines`), and lose only such lines.
    """
    order = ["host", "path", "digest"]
    lines = lines.withColumn("host", F.concat(F.when(F.col("vouched"), "article:").otherwise("page:"), "host"))
    common = common_lines(lines.where("vouched"))
    walked = lines.where("NOT vouched").withColumn("common", F.lit(None).cast("array<long>")).unionByName(lines.where("vouched").join(common, ["host", "digest"]))
    pages = walked.groupBy("host", "digest").agg(F.min("path").alias("path"), *[F.any_value(c).alias(c) for c in ("hashes", "sizes", "words", "common")])
    ranged = written(written(pages).repartitionByRange(*order).withColumn("slice", F.spark_partition_id()).withColumn("rank", F.lit(0))).select(*PAGE)
    sides = []
    for up, side in ((True, 1), (False, 0)):
        along = [F.asc(c) if up else F.desc(c) for c in order]
        against = [F.desc(c) if up else F.asc(c) for c in order]
        ends = ranged.repartition("slice").sortWithinPartitions("slice", *against).mapInArrow(_handed_on, PAGE_TYPES + ", whole boolean")
        starts = ends.repartition(1).sortWithinPartitions(F.asc("slice") if up else F.desc("slice"), F.desc("rank")).mapInArrow(_received, PAGE_TYPES)
        walked = ranged.unionByName(starts).repartition("slice").sortWithinPartitions("slice", "rank", *along)
        sides.append(walked.mapInArrow(_differenced, "host string, digest binary, nearness int, gone array<int>").withColumn("side", F.lit(side)))
    best = written(sides[0].unionAll(sides[1]).groupBy("host", "digest").agg(F.max_by("gone", F.struct("nearness", "side")).alias("gone")).where("size(gone) > 0")
                   .withColumnsRenamed({"host": "host_at", "digest": "digest_at"}))
    return lines.join(best, (F.col("host") == F.col("host_at")) & (F.col("digest") == F.col("digest_at"))) \
        .select(F.col("row").alias("gone_row"), "gone").dropDuplicates(["gone_row"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            blocks = page_blocks(html)[0]
            if gone:
                dropped = set(gone)
                blocks = [b for k, b in enumerate(blocks) if k not in dropped]
            texts.append("\n\n".join(blocks))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: (page_id, url, text, n_chars); text is empty where nothing is left.

    Null html is empty.  Pages without a host (null urls too) and the only page of a host are not differenced.
    Repeated rows get equal texts; an empty table gives no rows; columns other than the three are not read.
    The html is parsed twice and shuffled only where deletions are too many to broadcast.
    """
    bounded_batches(pages.sparkSession)
    host, path = url_parts(url)
    row = F.unhex(F.md5(F.concat_ws("/", *[F.md5(F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in (page_id, url, html)])))
    own = pages.select(row.alias("row"), F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    lines = pages.select(row.alias("row"), host.alias("host"), path.alias("path"), F.col(html).alias("html")) \
        .mapInArrow(_frame_lines, "row binary, host string, path string, vouched boolean, digest binary, hashes array<long>, sizes array<int>, words array<array<int>>")
    gone = written(shared_line_positions(written(lines)))  # written, since a range sort reads its input twice
    return own.join(gone, F.col("row") == F.col("gone_row"), "left").select("page_id", "url", "html", "gone") \
        .mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
