"""Main text of web pages, with site template removal.

A page is parsed into a light element tree (unclosed and misnested tags allowed). Boilerplate is known for sure by tag, role
or being hidden, and by name where a class or id word says so: the whole word, its last part, or its first part with only
layout words after it, and no part that negates it. Names can deceive, so a named element gives way where the page's only
article or main element lies in it, or, on pages without one, where hardly any text is left outside.

The template step: subtrees of the whole page are hashed, counted per host in Spark over pages of different content, and
deleted where they recur on at least max(``min_pages``, ``spread`` * sqrt(different pages of the host)) of them, so the share
that it takes falls as a host grows. Inside an article or main element a paragraph-level subtree counts only if at least half
of its text is in links, and no subtree that holds more than half of the text: copied articles and passages stay whole.

The container is what then remains of all top-level article and main elements, joined in page order; without one of them the
largest content-like element of at least half of the text, else the body.

Text: character references decoded, white space inside a block one space, blocks in page order joined by two newlines.

Defined results: null html counts as empty and gives an empty text; a page without a container gives what its body holds;
of equally large elements the first counts; repeated rows give equal rows; an empty table gives an empty table; extra columns
are not read. A null url has the host "". A very long page costs time and memory in proportion to its length.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.scratch import Scratch
from cinelake.llm.urls import split_url

MIN_PAGES, SPREAD = 5, 2.0
MAX_BROADCAST_BYTES = 16 << 20  # of hosts and hashes
SALTS = 64

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody "
    "tfoot thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "head", "html", "option", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "body": ("head",),
}
FENCE = frozenset("ul ol dl table article section div body html td th main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre blockquote li dt dd td th tr figcaption b i em strong a span".split())
# What is never main text, by tag, by role, and by class or id; and the layout words of class names.
DROP_TAGS = RAW | frozenset(
    "head nav footer aside form button select input menu dialog template svg canvas audio video object embed map datalist "
    "fieldset".split()
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
READER_NAMES = frozenset("comment comments disqus reply replies respond responses".split())
DROP_NAMES = READER_NAMES | frozenset(
    "ad ads adslot advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline consent cookie cookies "
    "copyright disclaimer foot footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification outbrain overlay pager pagination paywall popup promo promoted promotion recommended related search share sharing "
    "sidebar signin signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets".split()
)
LAYOUT_WORDS = frozenset(
    "area articles bar block bottom box btn button buttons card cards col column container content form group holder icon icons "
    "inner item items left link links list message middle outer panel posts rail right row section slot strip text thread title top "
    "unit wrap wrapper zone".split()
)
NEGATED = frozenset("has no non not with without".split())
CONTENT_NAMES = frozenset("article content entry main post story text body".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SOLID = frozenset(("#root", "html", "body", "main"))  # never dropped


class Node:
    """sure: boilerplate by tag, role or hidden; named: by class or id; explicit: article, main or their roles."""

    __slots__ = ("tag", "kids", "parent", "sure", "named", "reader", "content", "explicit", "digest", "size", "linked")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.kids: list[Node | str] = []
        self.sure = self.named = self.reader = self.content = False
        self.explicit = tag in ("article", "main")
        self.digest = self.size = self.linked = 0

    @property
    def dropped(self) -> bool:
        return self.sure or self.named


def names_boilerplate(word: str) -> bool:
    """Whether a class or id word names boilerplate."""
    parts = [p.lower() for p in _PART.findall(word)]
    if not parts or not NEGATED.isdisjoint(parts):
        return False
    rest = [p for p in parts[1:] if not p.isdigit()]
    return word.lower() in DROP_NAMES or parts[-1] in DROP_NAMES or parts[0] in DROP_NAMES and LAYOUT_WORDS.issuperset(rest)


def _judge(node: Node, attrs: str) -> None:
    node.sure = node.tag in DROP_TAGS
    if not attrs or attrs.isspace():
        return
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            role = value.strip().lower()
            node.sure |= role in DROP_ROLES
            node.explicit |= role in ("main", "article")
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            node.sure = True
        elif name == "style":
            node.sure |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name in ("class", "id"):
            for word in value.split():
                parts = {p.lower() for p in _PART.findall(word)}
                if names_boilerplate(word):
                    node.named = True
                    node.reader |= not READER_NAMES.isdisjoint(parts)
                node.content |= not CONTENT_NAMES.isdisjoint(parts)
    if node.tag in SOLID:
        node.sure = node.named = False


def parse(page: str) -> Node:
    """The element tree; raw-text elements keep no content."""
    root = Node("#root", None)
    here, at, n = root, 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            here.kids.append(references.unescape(page[at:]))
            break
        if m.start() > at:
            here.kids.append(references.unescape(page[at : m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            up = here
            inline = tag not in BLOCK and tag not in ("td", "th")
            while up.parent is not None and up.tag != tag and not (inline and up.tag in BLOCK):
                up = up.parent
            if up.parent is not None and up.tag == tag:
                here = up.parent
            continue
        if tag in CLOSES_P:
            up = here
            while up.parent is not None and up.tag != "p" and up.tag not in FENCE:
                up = up.parent
            if up.tag == "p":
                here = up.parent
        if tag in SIBLINGS:
            up, stop = here, None
            fence = FENCE - {"td", "th"} if tag in ("tr", "tbody", "td", "th") else FENCE
            while up.parent is not None and up.tag not in fence:
                if up.tag in SIBLINGS[tag]:
                    stop = up
                up = up.parent
            if stop is not None:
                here = stop.parent
        node = Node(tag, here)
        _judge(node, m[3] or m[6] or "")
        here.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/"):
            here = node
    return root


def _walk(root: Node, off: bool) -> list[Node]:
    """Nodes in page order without sure boilerplate, and without named one unless ``off``."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not k.sure and (off or not k.named)]
    return out


def _own(text: str) -> str:
    return "".join(text.split())


def _settle(root: Node) -> None:
    """Takes back names that deceive (see above)."""
    nodes = _walk(root, True)
    inside = {}
    for x in nodes:
        inside[x] = x.named or x.parent is not None and inside[x.parent]
    size: dict[Node, int] = {}
    for x in reversed(nodes):
        size[x] = sum(len(_own(k)) if isinstance(k, str) else 0 if k.sure else size[k] for k in x.kids)
    explicit = [x for x in nodes if x.explicit and size[x]]
    if explicit:
        if all(inside[x] for x in explicit):
            up: Node | None = max(explicit, key=lambda x: (not x.reader, size[x]))
            while up is not None:
                up.named = False
                up = up.parent
        return
    tops = [x for x in nodes if x.named and not inside[x.parent]]
    if 5 * (size[root] - sum(size[x] for x in tops)) < size[root]:
        best = max(tops, key=lambda x: (not x.reader, size[x]))
        best.named = best.reader


def _measure(root: Node) -> list[Node]:
    """Sets size (characters that are not white space, dropped subtrees apart), linked (those in links) and digest."""
    nodes = _walk(root, True)
    for node in reversed(nodes):
        h, size, linked = xxhash.xxh3_64(node.tag.encode()), 0, 0
        for k in node.kids:
            if isinstance(k, str):
                own = _own(k)
                size += len(own)
                if own:
                    h.update(own.encode("utf-8", "surrogatepass"))
            elif not k.dropped:
                size += k.size
                linked += k.linked
                h.update(b"\0" + k.digest.to_bytes(8, "little"))
        node.size, node.digest = size, h.intdigest()
        node.linked = size if node.tag == "a" else linked
    return nodes


def _explicit(root: Node) -> list[Node]:
    """The top-level article and main elements with text, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.explicit and node.size:
            out.append(node)
        else:
            todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not k.dropped]
    return out


def containers(root: Node) -> tuple[list[Node], bool]:
    """(the elements that hold the main text of a measured tree, whether they are explicit)."""
    found = _explicit(root)
    if found:
        return found, True
    nodes = [x for x in _walk(root, False) if x.size]
    for fits in (lambda x: x.content and x.tag not in SOLID and 2 * x.size >= root.size, lambda x: x.tag == "body"):
        some = [x for x in nodes if fits(x)]
        if some:
            return [max(some, key=lambda x: x.size)], False
    return [root], False


def _tree(page: str) -> Node:
    root = parse(page)
    _settle(root)
    _measure(root)
    return root


def _countable(root: Node) -> Iterator[Node]:
    """The subtrees of a measured tree that may be template."""
    tops, explicit = containers(root)
    within: dict[Node, Node] = {}
    holds = set()
    for top in tops:
        up = top.parent
        while explicit and up is not None:
            holds.add(up)
            up = up.parent
        for x in _walk(top, True) if explicit else ():
            within[x] = top
    for x in _walk(root, True):
        top = within.get(x)
        if not x.size or x in holds or x is top or x.tag in SOLID or x.tag not in BLOCK | PARAGRAPHS:
            continue
        if top is None or 2 * x.size <= top.size and (x.tag not in PARAGRAPHS or 2 * x.linked >= x.size):
            yield x


def candidates(page: str) -> tuple[int, set[int]]:
    """(digest of the content, digests of the subtrees that may be template)."""
    root = _tree(page)
    content = xxhash.xxh3_64(b"".join(x.digest.to_bytes(8, "little") for x in containers(root)[0])).intdigest()
    return content, {x.digest for x in _countable(root)}


def main_text(page: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the containers without boilerplate and template subtrees."""
    root = _tree(page)
    if template:
        gone = [x for x in _countable(root) if x.digest in template]
        for x in gone:
            x.sure = True
        if gone:
            _measure(root)
    tops, explicit = containers(root)
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        block = " ".join("".join(parts).split())
        parts.clear()
        if block:
            blocks.append(block)

    todo: list[Node | str | None] = tops[::-1]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            parts.append(x)
        elif x.dropped and x.tag not in SOLID:
            if x.tag in BLOCK:
                flush()
        else:
            if x.tag in ("br", "td", "th"):
                parts.append(" ")
            kids = x.kids
            if x.tag == "header":  # of its own header an article keeps the headings, a page nothing
                kids = [k for k in _walk(x, False) if k.tag in HEADINGS] if explicit else []
            if x.tag in BLOCK:
                flush()
                todo.append(None)
            todo += kids[::-1]
    flush()
    return "\n\n".join(blocks)


def _subtrees(pages: DataFrame) -> DataFrame:
    """pages(url, html) -> host, content, subtree: one row per page and candidate, and one without a subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, contents, trees = [], [], []
            for url, page in zip(b.column(0), b.column(1)):
                content, found = candidates(page.as_py() or "")
                host = split_url(url.as_py())[0]
                for d in (None, *found):
                    hosts.append(host)
                    contents.append(content - (1 << 63))
                    trees.append(None if d is None else d - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(trees, pa.int64())],
                names=["host", "content", "subtree"],
            )

    return pages.mapInArrow(run, "host string, content bigint, subtree bigint")


def site_templates(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, spread: float = SPREAD,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(host, subtree) of the subtrees that recur over pages of different content. Parses every page once."""
    scratch = scratch or Scratch(pages.sparkSession, "html")
    seen = _subtrees(pages.select(url_col, html_col)).distinct()
    counts = scratch.keep(seen.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {min_pages} or subtree is null"), "counts")
    total = counts.where("subtree is null").select(F.col("host").alias("h2"), F.col("n").alias("total"))
    often = counts.where("subtree is not null").join(total, F.col("host") == F.col("h2"))
    return often.where(F.col("n") >= F.sqrt("total") * spread).select("host", "subtree")


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
    spread: float = SPREAD,
) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    scratch = Scratch(pages.sparkSession, "html")
    templates = scratch.keep(site_templates(pages, url_col, html_col, min_pages, spread, scratch), "templates")
    scratch.release(templates)
    size = templates.agg(F.sum(F.octet_length("host") + 16)).first()[0] or 0
    src = pages.select(id_col, url_col, html_col)
    out = T.StructType([*src.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    if size:
        by_host = templates.groupBy(F.col("host").alias("__host")).agg(F.sort_array(F.collect_list("subtree")).alias("__t"))
        url = F.coalesce(F.col(url_col), F.lit(""))
        after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
        host = F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        on = F.col("__h") == F.col("__host")
        src = src.withColumn("__h", host)
        if size <= MAX_BROADCAST_BYTES:
            by_host = F.broadcast(by_host)
        else:  # a hot host's pages go to SALTS keys, each with its own copy of the host's templates
            src = src.withColumn("__s", F.pmod(F.xxhash64(id_col, html_col), F.lit(SALTS)).cast("int"))
            by_host = by_host.withColumn("__s2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            on = on & (F.col("__s") == F.col("__s2"))
        src = src.join(by_host, on, "left").select(id_col, url_col, html_col, "__t")
    else:
        src = src.withColumn("__t", F.lit(None).cast("array<bigint>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [
                main_text(page.as_py() or "", frozenset(x + (1 << 63) for x in t.as_py() or ()))
                for page, t in zip(b.column(2), b.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=[f.name for f in out],
            )

    return src.mapInArrow(run, out)
