"""HTML extraction by consensus host paths.

Pages of one host share templates, so the place of the article is a property
of the host. Each page scores its containers by the text of their own blocks
(length and punctuation, less what stands in links, tag and class adding or
taking) and votes for the generalised path of the best ones: the tags and
classes from the body down, digits replaced by ``#``. Spark adds up the votes
by host and path, the winning path of each host goes back to its pages, and
the text is taken again from the containers on that path. A page without such
a container falls back to its own best one.

Votes are pre-aggregated, so a host with a third of all pages sends one row
per task and path. Winners are broadcast if their counted bytes allow,
otherwise joined by a shuffle that the adaptive planner may split.

Defined results: a null, empty or text-less page gives an empty text; a null
or unusual url counts as one host of its own kind; markup errors (unclosed or
stray tags, cut entities) are read as browsers do for block structure; equal
votes go to the outer container. Time and memory grow with the page's length,
however deep its tags are nested.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, stored, table

# Tags by their part in a page.
CONTAINERS = frozenset("body article main section div td center".split())
BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd dl ul ol pre blockquote figure figcaption table thead tbody tfoot tr th caption hr address "
    "details summary fieldset header footer nav aside form noscript html".split()
) | CONTAINERS
#: Tags whose whole content is never article text.
DROPPED = frozenset("nav aside footer form noscript dialog menu template iframe object button select figure-ad".split())
#: Their content isn't markup.
RAW = "script|style|title|textarea|svg|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Words in a class, id or role that mark what isn't the article.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|reply|replies|respond|disqus|cookies?|consent|gdpr|notice|footer|header|masthead|"
    r"menu|nav\w*|newsletter|subscribe|signup|login|pager|pagination|popup|modal|promo\w*|related|recommend\w*|share|sharing|social|sidebar|"
    r"side|sponsor\w*|teaser|toolbar|widget|skip|outbrain|taboola)(?:$|[\s_-])",
    re.IGNORECASE,
)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|text|story|blog|hentry)(?:$|[\s_-])", re.IGNORECASE)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)

#: Best containers of a page that get a vote.
VOTES = 3


@dataclass(eq=False)
class Element:
    tag: str
    step: str  # tag and classes, numbers as #
    parent: "Element | None"
    dropped: bool
    bonus: float
    in_article: bool
    depth: int
    key: bytes  # digest of the path, so that deep ones take no more room
    text: float = 0.0
    linked: float = 0.0
    blocks: int = 0

    @property
    def path(self) -> str:
        steps, e = [], self
        while e is not None and e.step:
            steps.append(e.step)
            e = e.parent
        return "/".join(reversed(steps))


@dataclass
class Page:
    """Blocks of text in page order, each with the elements it stands in."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[str, Element]] = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def _element(tag: str, raw: str, parent: Element) -> Element:
    a = _attributes(raw)
    names = " ".join(a.get(k, "") for k in ("class", "id", "role"))
    step = tag + "".join("." + re.sub(r"\d+", "#", c) for c in sorted(a.get("class", "").split())[:3])
    unlikely = tag in DROPPED or "hidden" in a or a.get("aria-hidden") == "true" or (tag == "header" and not parent.in_article)
    if tag not in ("body", "article", "main", "html") and UNLIKELY.search(names) and not (tag == "header" and parent.in_article):
        unlikely = True
    bonus = {"article": 2.0, "main": 1.6, "section": 1.1}.get(tag, 1.0) * (1.25 if LIKELY.search(names) else 1.0)
    key = hashlib.blake2b(step.encode(), digest_size=16, key=parent.key).digest()
    return Element(tag, step, parent, unlikely or parent.dropped, bonus, parent.in_article or tag in ("article", "main"), parent.depth + 1, key)


def parse(source: str) -> Page:
    """One pass over the markup: containers on a stack, text gathered up to
    the next block border. Inline tags leave no trace, ``br`` is white space.
    Beyond the last ``>`` there is no tag to look for."""
    page = Page()
    root = Element("html", "", None, False, 0.5, False, 0, b"")
    stack = [root]
    open_tags: Counter[str] = Counter()  # on the stack
    text: list[str] = []
    linked = 0
    in_link = in_head = False
    at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            if block:
                here = stack[-1]
                page.blocks.append((block, here))
                if not here.dropped:
                    here.blocks += 1
                    here.text += min(len(block), 2000) / 100 + block.count(",") + block.count(".")
                    here.linked += min(linked, len(block)) / 100
            text.clear()
        linked = 0

    for m in TOKEN.finditer(source, 0, source.rfind(">") + 1):
        if m.start() > at and not in_head:
            piece = source[at : m.start()]
            text.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        tag = m[3].lower() if m[3] else None
        if tag is None:
            continue
        closing = bool(m[2])
        if tag == "head":
            in_head = not closing
        elif tag == "body":
            in_head = False
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            text.append(" ")
        if tag not in BLOCKS and tag not in DROPPED:
            continue
        flush()
        in_link = False
        if tag in VOID or tag in ("p", "li", "dt", "dd", "tr", "th", "html") or tag[0] == "h" and len(tag) == 2:
            continue
        if not closing:
            if tag == "body" and open_tags["body"]:
                continue
            element = _element(tag, m[4] or "", stack[-1])
            page.elements.append(element)
            if not (m[4] or "").rstrip().endswith("/"):
                stack.append(element)
                open_tags[tag] += 1
        elif open_tags[tag]:
            while (last := stack.pop().tag) != tag:
                open_tags[last] -= 1
            open_tags[tag] -= 1
    if at < len(source) and not in_head:
        text.append(re.sub(r"<[a-zA-Z/!][^>]*\Z", "", source[at:]))
    flush()
    page.elements.append(root)
    return page


def scores(page: Page) -> list[tuple[float, Element]]:
    """Containers by score, best first: their own blocks, and half of those
    of the elements right below, times what tag and class say."""
    points = {id(e): (e.text, e.linked) for e in page.elements}
    passed: dict[int, tuple[float, float]] = {}  # what goes on to the element above
    for e in sorted(page.elements, key=lambda e: -e.depth):
        if e.parent is None:
            continue
        # a list, quote or table counts in full, up to the next container
        share = (0.5 if e.tag in CONTAINERS else 1.0) if e.blocks and not e.dropped else 0.0
        t, x = (0.0, 0.0) if e.tag in CONTAINERS else passed.get(id(e), (0.0, 0.0))
        t, x = t + share * e.text, x + share * e.linked
        if t or x:
            for table in (points, passed):
                own = table.get(id(e.parent), (0.0, 0.0))
                table[id(e.parent)] = (own[0] + t, own[1] + x)
    out = []
    for order, e in enumerate(page.elements):
        t, x = points[id(e)]
        if t > 0 and not e.dropped and (e.tag in CONTAINERS or e.tag == "html"):
            out.append((t * max(0.0, 1 - x / t) * e.bonus, -order, e))
    return [(s, e) for s, _, e in sorted(out, key=lambda x: (-x[0], -x[1])) if s > 0]


def text_on(page: Page, key: bytes | None) -> str:
    """The blocks of all containers on the path, else of the best one."""
    chosen = {id(e) for e in page.elements if e.key == key and not e.dropped} if key is not None else set()
    kept = _within(page, chosen)
    if not kept:
        best = scores(page)
        kept = _within(page, {id(best[0][1])}) if best else []
    return "\n".join(kept)


def _within(page: Page, chosen: set[int]) -> list[str]:
    """Blocks that stand in one of the chosen elements and aren't dropped."""
    inside: dict[int, bool] = {}
    for e in sorted(page.elements, key=lambda e: e.depth):
        inside[id(e)] = id(e) in chosen or (e.parent is not None and inside[id(e.parent)])
    return [b for b, e in page.blocks if inside[id(e)] and not e.dropped]


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """``(host, path, depth, points)``: one vote a page, shared by score among
    its best containers, added up within a task. ``path`` is the path's digest."""
    arrow = pa.schema([("host", pa.string()), ("path", pa.binary()), ("depth", pa.int32()), ("points", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, 2048):
            own: dict[tuple[str, bytes], list] = {}
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                best = scores(parse(source or ""))[:VOTES]
                total = sum(s for s, _ in best)
                for s, e in best:
                    box = own.setdefault((host, e.key), [e.depth, 0.0])
                    box[1] += s / total
            rows = [(h, p, d, x) for (h, p), (d, x) in own.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    return pages.select(host_of().alias("host"), "html").mapInArrow(run, "host string, path binary, depth int, points double")


def winning_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)`` with the most points, of equal ones the path of the
    outer container; points are rounded so that their order doesn't depend on
    the order of adding."""
    total = votes(pages).groupBy("host", "path").agg(F.round(F.sum("points"), 6).alias("points"), F.min("depth").alias("depth"))
    best = F.min_by("path", F.struct((-F.col("points")).alias("p"), "depth", "path"))
    return total.groupBy("host").agg(best.alias("path"))


#: Hosts up to which the winners are broadcast, and bytes that these may take:
#: a path is a digest, only the names of hosts vary.
BROADCAST_HOSTS, BROADCAST_BYTES = 200_000, 32 << 20


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``."""
    winners = stored(winning_paths(pages), "host-paths")
    size = winners.agg(F.count("*").alias("n"), F.sum(F.octet_length("host") + 64).alias("b")).first()
    few = size.n <= BROADCAST_HOSTS and (size.b or 0) <= BROADCAST_BYTES
    keep = pages.drop("text")
    winners = winners.select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    met = keep.withColumn("_host", host_of()).join(F.broadcast(winners) if few else winners, "_host", "left")
    met = met.select(*keep.columns, "_path")
    names = keep.columns
    at = names.index("html")
    schema = keep.withColumn("text", F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at, 256):
            paths = batch.column(len(names)).to_pylist()
            texts = [text_on(parse(s or ""), p) for s, p in zip(batch.column(at).to_pylist(), paths)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, "text"])

    return met.mapInArrow(run, schema)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    text = F.coalesce(F.col("text"), F.lit(""))
    return extract(pages).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
