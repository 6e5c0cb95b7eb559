"""Main-text extraction with host paths agreed on by the pages of a host.

1. Every page is parsed and its containers scored: a text block counts, less
   its link text, for its container in full and for each container above with
   half of the weight below. The best containers vote for their path: tags and
   classes from the body down, digits generalised.
2. Spark sums the votes per host and path.
3. Every page is read again with its host's paths, most votes first: the first that
   the page has gives the text; a page with none of them uses its own best container.
   Pages of hosts with many voted paths find theirs in a join of their own paths
   with the votes, so no list grows with a host and no voted path is left out.

Boilerplate inside the container (menus, headers, footers, sidebars, notices,
adverts, forms, comments) is left out by tag, role or class. Such a mark is
void where it would take the article: on an element with most of the page's
text beside which almost none is left (a form or wrapper around the whole page,
a menu that is never closed). Marks inside that element hold. Blocks are cleaned
as one: character references decoded, white space folded, joined by a space.

Defined results: null, empty or text-free pages give an empty text, and so do
pages whose only text is a short marked element (a lone notice); a null or
odd url counts as the host ''; equal rows get equal results; input columns
named like the results are replaced. Paths are kept as digests, so time and
memory grow with the page, however deep its tags are nested.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.llm.common import arrow_schema, stage, without

#: Up to this many voted paths a host's pages get them as a list; beyond it each page's best comes by a join.
PATHS_PER_HOST = 32
#: Containers with at least this share of the page's best score vote as well, with that share.
VOTE_SHARE = 0.6
#: Host tables up to this many rows (about 100 bytes each) are broadcast, larger ones are joined by a shuffle.
BROADCAST_HOSTS = 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*>",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Tags whose text is never part of the article.
DROPPED = frozenset("head nav header footer aside form button select dialog menu fieldset".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words in class or id names that mark boilerplate.
MARKED = frozenset(
    "nav navbar navigation menu masthead footer sidebar aside ad ads advert advertisement adverts sponsor sponsored promo "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup social share "
    "sharing related recommended breadcrumb breadcrumbs pagination pager comment comments commentlist disqus reply replies "
    "respond form search login widget widgets toolbar copyright".split()
)
HEADS = frozenset(("header", "site-header", "page-header", "topbar", "top-bar"))
#: An element that starts closes these open ones (text blocks can't hold blocks).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FAVOURED = {"article": 1.5, "main": 1.3}
#: A mark is void on an element with most of the page's text and this many times the text left beside it.
VOID_SHARE = 20
#: Without an article, main or heading inside, such an element needs this many characters.
VOID_CHARS = 250
EVIDENCE = frozenset(("article", "main", "h1", "h2"))
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}


@dataclass
class Box:
    """A block-level element that can hold the article."""

    parent: int
    #: Digest of the tags and classes from the body down, and their length.
    path: str
    length: int
    tag: str
    score: float = 0.0


@dataclass
class Mark:
    """An element marked as boilerplate."""

    parent: int
    #: Characters outside links, and whether an article or heading stands inside.
    chars: int = 0
    evidence: bool = False
    dropped: bool = True


@dataclass
class Page:
    boxes: list[Box] = field(default_factory=list)
    #: (box, text, link characters) of each clean block outside boilerplate, in page order.
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _marks(tag: str, attrs: str) -> tuple[bool, str]:
    """Whether an element is boilerplate, and its classes with digits generalised."""
    dropped, classes = tag in DROPPED, ""
    if attrs and ("=" in attrs or "hidden" in attrs):
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                if tag != "body" and tag != "html":
                    dropped |= not MARKED.isdisjoint(_WORDS.findall(value)) or not HEADS.isdisjoint(value.split())
                if name == "class":
                    classes = "." + ".".join(sorted(re.sub(r"\d+", "0", value).split())) if value.strip() else ""
            elif name == "role":
                dropped |= value in ROLES
            elif name == "style":
                dropped |= "display:none" in value.replace(" ", "")
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                dropped = True
    return dropped, classes


def settle(marks: list[Mark]) -> None:
    """Void the marks that would take the article. ``marks[0]`` stands for all that is unmarked."""
    own = [m.chars for m in marks]
    for m in reversed(marks[1:]):  # parents stand before their children
        marks[m.parent].chars += m.chars
        marks[m.parent].evidence |= m.evidence
    marks[0].dropped, left, total = False, own[0], marks[0].chars
    for i, m in enumerate(marks[1:], 1):
        if marks[m.parent].dropped or 2 * m.chars <= total or VOID_SHARE * left > m.chars:
            continue
        if m.evidence or m.chars >= VOID_CHARS:
            m.dropped = False
            left += own[i]


def parse(source: str) -> Page:
    """One pass over the tags; text between them is only sliced and joined."""
    page = Page([Box(-1, "", 0, "body")])
    stack: list[tuple[str, int, int, bool]] = []  # tag, box, mark, in a link
    opened: Counter[str] = Counter()  # tags on the stack
    unclosed: set[str] = set()  # raw tags without an end from here on
    marks = [Mark(0)]
    box, mark, link = 0, 0, False
    raw: list[tuple[int, list[tuple[int, str, bool]]]] = []
    parts: list[tuple[int, str, bool]] = []  # mark, text, in a link
    at = 0

    def flush():
        nonlocal parts
        if parts:
            raw.append((box, parts))
            parts = []

    def leave(k: int):
        nonlocal box, mark, link
        for entry in stack[k:]:
            opened[entry[0]] -= 1
        del stack[k:]
        _, box, mark, link = stack[-1] if stack else ("", 0, 0, False)

    def enter(tag: str, bad: bool):
        nonlocal mark
        if bad:
            marks.append(Mark(mark))
            mark = len(marks) - 1
        if tag in EVIDENCE:
            marks[mark].evidence = True
        stack.append((tag, box, mark, link))
        opened[tag] += 1

    while True:
        m = _TOKEN.search(source, at)
        end = m.start() if m else len(source)
        if end > at:
            text = source[at:end]
            parts.append((mark, text, link))
            if not link:
                marks[mark].chars += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if opened[tag] > 0:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
                if any(s[0] not in INLINE for s in stack[k:]):
                    flush()
                leave(k)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                parts.append((mark, " ", False))
            continue
        if tag in RAW:
            close = None if tag in unclosed else _CLOSE[tag].search(source, at)
            if close is None:
                unclosed.add(tag)
            if close is not None or tag in ("script", "style", "textarea", "title"):
                nxt = source.find(">", close.start()) if close is not None else -1
                at = nxt + 1 if nxt >= 0 else len(source)
            continue
        attrs = m["attrs"] or ""
        bad, classes = _marks(tag, attrs)
        if tag in INLINE:
            link = link or tag == "a"
            enter(tag, bad)
            continue
        flush()
        shut = CLOSES.get(tag, ())
        for k in range(len(stack) - 1, -1, -1):
            name = stack[k][0]
            if name == "p" or name in shut or (len(tag) == 2 and tag[0] == "h" == name[0] and len(name) == 2 and tag[1].isdigit()):
                leave(k)
                break
            if name not in INLINE:
                break
        if tag in ("html", "body"):
            box = 0
            enter(tag, False)
            continue
        step, above = f"/{tag}{classes}", page.boxes[box]
        digest = hashlib.blake2b((above.path + step).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
        page.boxes.append(Box(box, digest, above.length + len(step), tag))
        box = len(page.boxes) - 1
        enter(tag, bad)
    flush()
    settle(marks)
    for where, pieces in raw:
        kept = [(text, linked) for of, text, linked in pieces if not marks[of].dropped]
        text = "".join([text for text, _ in kept])
        if "&" in text:
            text = htmllib.unescape(text)
        text = " ".join(text.split())
        if text:
            page.blocks.append((where, text, sum(len(t) for t, linked in kept if linked)))
    return page


def score(page: Page) -> None:
    """Each block counts for its container and, halved at every step, for those above it."""
    for box, text, linked in page.blocks:
        weight = max(0.0, len(text) - 2.0 * linked)
        if page.boxes[box].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "dd"):
            box = max(0, page.boxes[box].parent)
        while box >= 0 and weight > 0:
            page.boxes[box].score += weight
            box, weight = page.boxes[box].parent, weight / 2
    for b in page.boxes:
        b.score *= FAVOURED.get(b.tag, 1.0)


def best_box(page: Page) -> int:
    return max(range(len(page.boxes)), key=lambda i: (page.boxes[i].score, i))


def votes(page: Page) -> dict[tuple[str, int], float]:
    """Share of the best score of each path (with its length) that the page votes for."""
    score(page)
    top = max(b.score for b in page.boxes)
    out: dict[tuple[str, int], float] = {}
    if top > 0:
        for b in page.boxes:
            if b.score >= VOTE_SHARE * top:
                out[b.path, b.length] = max(out.get((b.path, b.length), 0.0), b.score / top)
    return out


def text_of(page: Page, paths: list[str] | None) -> str:
    """Text of the first of the host's paths that holds any, else of the page's own best container."""
    inside: set[int] = set()

    def chosen(roots: set[int]) -> str:
        inside.clear()
        for i, b in enumerate(page.boxes):  # parents stand before their children
            if i in roots or b.parent in inside:
                inside.add(i)
        return " ".join(text for box, text, _ in page.blocks if box in inside)

    for path in paths or ():
        roots = {i for i, b in enumerate(page.boxes) if b.path == path}
        if roots and (text := chosen(roots)):
            return text
    if not page.blocks:
        return ""
    score(page)
    return chosen({best_box(page)})


def host(url: Column) -> Column:
    """Host of a url, lower-case, without user and port; '' where there is none."""
    part = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return part


def text_paths(page: Page) -> set[str]:
    """Paths of the containers that hold any text."""
    seen: set[int] = set()
    for box, _, _ in page.blocks:
        while box >= 0 and box not in seen:
            seen.add(box)
            box = page.boxes[box].parent
    return {page.boxes[i].path for i in seen}


def host_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, path, place: the voted container paths of each host; the smallest place has most votes.

    Votes are summed before and after the shuffle, so a host with a third of
    all pages moves as few rows as it has distinct paths per task.
    """

    def run(batches):
        for batch in batches:
            hosts, paths, lengths, shares = [], [], [], []
            for h, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for (path, length), share in votes(parse(source or "")).items():
                    hosts.append(h)
                    paths.append(path)
                    lengths.append(length)
                    shares.append(round(share * 1000))
            yield pa.RecordBatch.from_pydict({
                "host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string()),
                "length": pa.array(lengths, pa.int64()), "share": pa.array(shares, pa.int64()),
            })

    cast = pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html")).mapInArrow(run, "host string, path string, length long, share long")
    counted = cast.groupBy("host", "path").agg(F.sum("share").alias("votes"), F.max("length").alias("length"))
    # of paths with equal votes the longer, then the first by digest
    return counted.select("host", "path", F.struct((-F.col("votes")).alias("v"), (-F.col("length")).alias("l"), F.col("path").alias("p")).alias("place"))


def best_paths(pages: DataFrame, voted: DataFrame) -> DataFrame:
    """host, page, path: of each distinct page (host, html) the path with most votes that it holds text in."""

    def run(batches):
        for batch in batches:
            hosts, marks, paths = [], [], []
            for h, mark, source in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html")), strict=True):
                for path in text_paths(parse(source)):
                    hosts.append(h)
                    marks.append(mark)
                    paths.append(path)
            yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "page": pa.array(marks, pa.string()), "path": pa.array(paths, pa.string())})

    own = pages.where("html IS NOT NULL").select("host", "page", "html").mapInArrow(run, "host string, page string, path string")
    best = own.join(voted, ["host", "path"]).groupBy("host", "page").agg(F.min("place").alias("place"))
    return best.select("host", "page", F.col("place.p").alias("path"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """Replace the html column by the page's main text in ``out``."""
    voted = stage(host_votes(pages, url, html), "host-votes")
    sizes = voted.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    hosts = stage(sizes.where(F.col("n") > PATHS_PER_HOST).select("host"), "wide-hosts")
    listed = voted.join(sizes.where(F.col("n") <= PATHS_PER_HOST).select("host"), "host", "left_semi")
    listed = listed.groupBy("host").agg(F.sort_array(F.collect_list("place")).alias("list"))
    agreed = stage(listed.select("host", F.col("list.p").alias("paths")), "host-paths")
    if agreed.count() <= BROADCAST_HOSTS:
        agreed = F.broadcast(agreed)
    # beyond that the join shuffles, and adaptive execution splits a hot host
    keep = [c for c in pages.columns if c.lower() not in (out.lower(), html.lower())]
    joined = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html).alias("__html"), host(F.col(url)).alias("__host"))
    paths = F.col("paths")
    if not hosts.isEmpty():
        wide = pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html")).withColumn("page", F.md5("html"))
        few = F.broadcast(hosts) if hosts.count() <= BROADCAST_HOSTS else hosts
        best = stage(best_paths(wide.join(few, "host", "left_semi"), voted.join(few, "host", "left_semi")), "best-paths")
        best = best.select(F.col("host").alias("__h"), F.col("page").alias("__p"), F.col("path").alias("__best"))
        best = F.broadcast(best) if best.count() <= BROADCAST_HOSTS else best
        joined = joined.withColumn("__page", F.md5("__html"))
        joined = joined.join(best, (F.col("__host") == F.col("__h")) & (F.col("__page") == F.col("__p")), "left")
        paths = F.coalesce(paths, F.when(F.col("__best").isNotNull(), F.array("__best")))
    joined = joined.join(agreed, joined["__host"] == agreed["host"], "left").select(
        *[joined[f"`{c}`"] for c in keep], "__html", paths.alias("__paths")
    )
    fields = [f for f in joined.schema.fields if f.name not in ("__html", "__paths")]
    schema = StructType([*fields, StructField(out, StringType(), False)])
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            texts = [
                text_of(parse(source), paths) if source else ""
                for source, paths in zip(batch.column("__html").to_pylist(), batch.column("__paths").to_pylist(), strict=True)
            ]
            columns = [*[batch.column(f.name) for f in fields], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    return joined.mapInArrow(run, schema)


def pages_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    got = extract(without(pages.select("page_id", "url", "html"), "text"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
