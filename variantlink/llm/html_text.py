"""Main text of web pages by nearest-URL page differencing (operator 9)."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|svg|title|annotation-xml|annotation)\b"
    r"(?:(?:(?<=svg)|(?<=annotation)|(?<=annotation-xml))[^>]*/>|[^>]*>.*?(?:</(?P=raw)\s*>|\Z))"  # in HTML itself a slash closes nothing
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr math semantics mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtext munder munderover".split()
)
#: Elements whose content is no part of an article, and those that hold the article.
ASIDE = frozenset("nav header footer aside form menu dialog head button select fieldset".split())
MAIN = frozenset(("article", "main"))
#: Those of them that an article ends: no article stands in a head, and a form may be laid around a whole page.
OPEN_TO_MAIN = frozenset("head form fieldset".split())
#: Words in class, id, role or label that mark such an element, those of them that do so inside an article too, words that may follow
#: a mark without changing what it is, and words before a mark that make it a remark about the element ("has-sidebar", "tag-ads").
WITHIN = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|pagination|pager|newsletter|subscribe|search|comments?|replies|respond"
)
MARK = re.compile(
    WITHIN.pattern + r"|banner|cookies?|consent|notices?|alert|popup|modal|dialog|sidebar|aside|masthead|header|footer"
    r"|share|sharing|social|related|contentinfo|complementary|toolbar"
)
CARRIERS = frozenset(
    "area bar block body bottom box button buttons card col column container content form group holder icon icons inner item items left link links list "
    "listing main outer overlay panel placeholder posts primary region right row secondary section slot stories text thread top unit widget wrap wrapper".split()
)
REMARKS = frozenset("cat category format has hide hidden is no non not page post show single tag template term topic type with without".split())
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
CLOSED_BY = {"p": frozenset("p".split()), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p"))}
#: Parts that the copies of one page are dealt over when they are given their partner.
SALTS = 64
SPACE = re.compile(r"\s+")


def marked(attrs: str, rule: re.Pattern = MARK) -> bool:
    """Whether a class, id, role or label names the element as something else than an article.

    Each name is read as a compound: it is a mark if a marking word stands in it, nothing behind that changes its meaning
    (a "share-price" is a price), and no word before turns it into a remark.
    """
    for value in NAMED.findall(attrs):
        for name in value.strip("\"'").lower().split():
            parts = [x for x in re.split(r"[^a-z0-9\u0080-\uffff]+", name) if x]
            at = next((k for k, x in enumerate(parts) if rule.fullmatch(x)), None)
            if at is None or not REMARKS.isdisjoint(parts[:at]):
                continue
            if all(x in CARRIERS or MARK.fullmatch(x) or re.search(r"\d", x) for x in parts[at + 1 :]):
                return True
    return False


@dataclass
class Block:
    text: str
    main: bool  # in an article or main element
    sole: bool  # in a main element, of which a page has one
    around: int  # marks on elements around its article, if any: 0 none, 1 some, 2 such as count inside an article too
    own: bool  # in an element that is something else by its name, or by a mark inside its article

    @property
    def aside(self) -> bool:
        return self.own or self.around > 0


def blocks_of(page: str) -> list[Block]:
    """Visible blocks in page order, white space collapsed, character references decoded."""
    found: list[Block] = []
    open_tags: list[tuple[str, Block]] = []  # tag, what its blocks are
    nothing = Block("", False, False, 0, False)
    words: list[str] = []
    ends = {tag: max((m.start() for m in re.finditer(rf"</{tag}\b", page, re.I)), default=-1) for tag in ASIDE - OPEN_TO_MAIN}

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(words))).strip()
        words.clear()
        if text:
            found.append(replace(open_tags[-1][1] if open_tags else nothing, text=text))

    def close(at: int) -> None:
        flush()
        del open_tags[at:]

    for m in PIECE.finditer(page):
        if m["text"]:
            words.append(m["text"])
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            words.append(" " if m["raw"] else "")
        elif m["end"]:
            at = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == tag), None)
            if at is None:
                if tag not in INLINE:
                    flush()
            elif tag in INLINE:
                if at == len(open_tags) - 1 and not open_tags[at][1].aside:
                    del open_tags[at:]
                elif all(x[0] in INLINE for x in open_tags[at:]):
                    close(at)
            else:
                close(at)
        elif tag in VOID:
            if tag in INLINE:
                words.append(" " if tag in ("br", "wbr") else "")
            else:
                flush()
        else:
            if tag not in INLINE:
                flush()
                while open_tags and open_tags[-1][0] in INLINE:  # an unclosed inline element ends with its block
                    open_tags.pop()
            if tag == "body" or tag in MAIN:  # ends a head or form, and a menu or footer that nobody closes
                left = lambda x: x in OPEN_TO_MAIN or x in ASIDE and (tag == "body" or ends[x] < m.start())  # noqa: B023, E731
                at = next((k for k, x in enumerate(open_tags) if left(x[0])), None)
                if at is not None:
                    close(at)
            if open_tags and open_tags[-1][0] in CLOSED_BY.get(tag, ("p",) if tag not in INLINE else ()):
                close(len(open_tags) - 1)
            up = open_tags[-1][1] if open_tags else nothing
            main, named, free = up.main or tag in MAIN, tag in ASIDE, tag in ("html", "body", "main")
            within = not free and marked(m["attrs"], WITHIN)
            level = 0 if free or main else 2 if within else int(marked(m["attrs"]))
            own = named or main and within
            if (own or level) and tag in INLINE:
                flush()
            open_tags.append((tag, Block("", main, up.sole or tag == "main", max(up.around, level), up.own or own)))
    flush()
    return found


#: Bits of a table of common lines that is kept whole; larger ones are halved first.
TABLE_BITS = 1 << 26


def rows_of(a: list, b: list) -> Iterator[int]:
    """Bit-parallel rows of the table of common lines: zeros mark where the common length grows along ``b``."""
    at: dict = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    yield v
    for x in a:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & full
        yield v


def lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``, from the last row alone."""
    for last in rows_of(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(last.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def aligned(a: list, b: list) -> list[int]:
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:  # the best cut of b for the two halves of a
        mid = len(a) // 2
        cut = int(np.argmax(lengths(a[:mid], b) + lengths(a[mid:][::-1], b[::-1])[::-1]))
        return aligned(a[:mid], b[:cut]) + [mid + k for k in aligned(a[mid:], b[cut:])]
    rows, chosen, j = [*rows_of(a, b)], [], len(b)
    for i in range(len(a), 0, -1):
        # go left to the last growth
        grows = ~rows[i] & (1 << j) - 1
        above = ~rows[i - 1] & (1 << j) - 1
        if grows.bit_count() > above.bit_count():
            # the last line of b that a[i-1] can take with this length
            j = (grows & ~above).bit_length() - 1
            while b[j] != a[i - 1]:
                j -= 1
            chosen.append(i - 1)
    return chosen[::-1]


def common_lines(a: list, b: list) -> list[int]:
    """Indices in ``a`` of a longest common subsequence with ``b``, in memory that grows with their lengths alone.

    Equal lines at both ends belong to it; lines that the other side lacks don't.
    """
    ends = min(len(a), len(b))
    head = next((k for k in range(ends) if a[k] != b[k]), ends)
    tail = next((k for k in range(ends - head) if a[-1 - k] != b[-1 - k]), ends - head)
    inner, other = a[head : len(a) - tail], b[head : len(b) - tail]
    both = set(inner) & set(other)
    at = [k for k, x in enumerate(inner) if x in both]
    middle = aligned([inner[k] for k in at], [x for x in other if x in both])
    return [*range(head), *(head + at[k] for k in middle), *range(len(a) - tail, len(a))]


def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line hashes of each page."""
    import xxhash

    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            lines = [[xxhash.xxh3_64_intdigest(b.text) >> 1 for b in blocks_of(x.as_py() or "")] for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("k1", "k2", "host", "path")), pa.array(lines, pa.list_(pa.int64()))],
                ["k1", "k2", "host", "path", "lines"],
            )


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which lines of each page its partner shares."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            shared = [common_lines(a.as_py() or [], b.as_py() or []) for a, b in zip(batch.column("lines"), batch.column("other"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(shared, pa.list_(pa.int32()))], ["k1", "k2", "shared"])


def article_of(blocks: list[Block], shared: set[int]) -> list[int]:
    """Indices of the blocks that are a page's main text; ``shared`` ones are also on the partner page.

    An article without marks around it alone counts. One in a marked wrapper is the page's own if it is in a main element, if nothing
    stands outside of marked elements, or if it is longer than what does (unless the wrapper is a menu, advert or the comments);
    else it is a teaser. On pages without an article shared blocks go.
    """
    plain = [k for k, b in enumerate(blocks) if not b.aside]
    if any(blocks[k].main for k in plain):
        return [k for k in plain if blocks[k].main]
    rest = [k for k in plain if k not in shared] or plain
    wrapped = [k for k, b in enumerate(blocks) if b.main and not b.own]
    size = sum(len(blocks[k].text) for k in rest)
    longer = sum(len(blocks[k].text) for k in wrapped if blocks[k].around < 2) > size
    return wrapped if longer or size == 0 or any(blocks[k].sole for k in wrapped) else rest


def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            texts, counts = [], []
            for page, own in zip(batch.column("html"), batch.column("shared"), strict=True):
                blocks, shared = blocks_of(page.as_py() or ""), set(own.as_py() or [])
                texts.append("\n\n".join(blocks[k].text for k in article_of(blocks, shared)))
                counts.append(len(shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["page_id", "url", "text", "n_shared"]
            )


def nearest_pages(keys: DataFrame) -> DataFrame:
    """``(k1, k2, o1, o2)``: for each page ``keys(k1, k2, host, path, u)`` the nearest by URL path in its host with another u.

    Pages are numbered in (host, path) order from range partitions and their sizes, so that a
    host may hold any share of the pages. In that order the longest common path prefix is with
    a neighbour; of equal ones the earlier is taken. A host's only page has no partner.

    u stands for a page's lines. A page with the same u as the page before it is a copy that tells nothing
    of what is shared: copies are left out of the order, so that each page has neighbours that
    differ, and get the partner of the first page by path with their host and u.
    """
    fields = ("host", "path", "k1", "k2", "u")
    ordered = keys.repartitionByRange(*fields).sortWithinPartitions(*fields)
    numbered = staged(ordered.withColumn("n", F.monotonically_increasing_id()), "ordered-pages")
    numbered = numbered.withColumn("part", F.shiftright("n", 33)).withColumn("local", F.col("n").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = numbered.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    ranked = numbered.join(bases, "part").select(*fields, (F.col("base") + F.col("local")).alias("rank"))

    def beside(step: int, name: str) -> DataFrame:
        return ranked.select((F.col("rank") - step).alias("rank"), F.struct(*fields).alias(name))

    def alike(name: str) -> Column:
        same = F.col(f"{name}.host") == F.col("host")
        a, b = F.split("path", ""), F.split(F.col(f"{name}.path"), "")
        differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
        length = F.when(differs == 0, F.least(F.size(a), F.size(b))).otherwise(differs - 1)
        return F.coalesce(F.when(same, length.cast("int")), F.lit(-1))

    both = ranked.join(beside(-1, "earlier"), "rank", "left").join(beside(1, "later"), "rank", "left")
    e, n = alike("earlier"), alike("later")
    other = F.when((e >= 0) & (e >= n), F.col("earlier")).when(n >= 0, F.col("later"))
    copy = F.coalesce((F.col("earlier.host") == F.col("host")) & (F.col("earlier.u") == F.col("u")), F.lit(False))
    near = staged(
        both.select("k1", "k2", F.when(copy, F.col("host")).alias("host"), F.when(copy, F.col("u")).alias("u"), copy.alias("copy"), other.alias("o"))
        .select("k1", "k2", "host", "u", "copy", F.col("o.k1").alias("o1"), F.col("o.k2").alias("o2")),
        "neighbours",
    )
    copies = near.where("copy").select("k1", "k2", "host", "u", F.pmod("k1", F.lit(SALTS)).alias("salt"))
    if copies.isEmpty():
        return near.select("k1", "k2", "o1", "o2")
    first = staged(keys.join(copies.select("k1", "k2"), ["k1", "k2"], "left_anti"), "first-pages")
    found = staged(nearest_pages(first), "first-partners")
    given = first.join(copies.select("host", "u").distinct(), ["host", "u"], "left_semi").join(found, ["k1", "k2"])
    given = given.groupBy("host", "u").agg(F.min(F.struct("path", "k1", "k2", "o1", "o2")).alias("p")).select("host", "u", "p.o1", "p.o2")
    given = given.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return found.union(copies.join(given, ["host", "u", "salt"]).select("k1", "k2", "o1", "o2"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: page_id, url, text, n_chars, n_shared (blocks that the partner shares).

    Each page is paired with the nearest by URL path in its host that has other lines; blocks of the two
    are aligned by longest common subsequence, as hashes, and shared ones deleted; pages themselves move only
    if those with shared blocks are too many to be broadcast. A page whose every unmarked
    block is shared keeps them all: it is part of a near copy. Blocks in a page's article or main element
    that is neither marked nor in a marked one (teasers, comments) are never deleted for being shared
    (two pages may quote one passage), and where there is such an element it alone counts; blocks marked as menu, header, footer, sidebar, notice, advert, form
    or comments go in any case.

    Null html counts as empty and gives an empty text; null urls share one host. Repeated rows are
    one page in the pairing and give repeated results. A marked wrapper around the page's only article doesn't hide it, and
    marks inside an article count for menus, forms, adverts and comments alone. Other columns are ignored; an empty table
    gives an empty result.
    """
    own = pages.select("page_id", "url", "html")
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in ("page_id", "url", "html")]
    own = own.withColumns({"k1": F.xxhash64(*filled), "k2": F.xxhash64(F.lit("second"), *filled)})
    url = F.coalesce("url", F.lit(""))
    outlines = own.select(
        "k1",
        "k2",
        F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"),
        "html",
    ).mapInArrow(outlined, "k1 long, k2 long, host string, path string, lines array<long>")
    outlines = staged(outlines, "outlines")
    nearest = nearest_pages(outlines.select("k1", "k2", "host", "path", F.xxhash64("lines").alias("u")).distinct()).where(F.col("o1").isNotNull())
    lines = staged(outlines.select("k1", "k2", "lines").dropDuplicates(["k1", "k2"]), "page-lines")
    partners = nearest.join(lines, ["k1", "k2"]).join(lines.withColumnsRenamed({"k1": "o1", "k2": "o2", "lines": "other"}), ["o1", "o2"])
    shared = partners.select("k1", "k2", "lines", "other").mapInArrow(compared, "k1 long, k2 long, shared array<int>")
    shared = staged(shared.where(F.size("shared") > 0), "shared-lines")
    paired = own.join(shared, ["k1", "k2"], "left").select("page_id", "url", "html", "shared")
    kind = dict(pages.dtypes)["page_id"]
    text = paired.mapInArrow(extracted, f"page_id {kind}, url string, text string, n_shared long")
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_shared")
