"""HTML extraction with site style trees.

Pass one reads every page, menus, footers and all, into blocks of text with their
style nodes (tags and classes from the root) and sends a row per distinct (node, text
hash) and one per node with the hash of the nodes before it.  Counted per host that is the
merged style tree of the site: a node whose texts recur over its pages, or that
always looks the same, carries little.  A node's importance is one minus the mean normalised
entropy of its texts, raised by the entropy of its presentations.  Pass two reads
each page again and leaves out the nodes of low importance on its host.

Low is what lies under LOW beside better nodes and, on hosts of ENOUGH pages, what
lies under the widest gap between the importances of its nodes, if the gap is MIN_GAP
wide and what lies over it holds nearly all of the text: menus, adverts and footers
draw on few texts, articles do not.  Nodes are judged low only against better
ones on the same host, so a site of copies keeps its text.

What tags and names say outright is known beforehand, for small hosts and for what
differs from page to page: menus, footers, forms, scripts, adverts, comments and the like are
left out on any host, and where a page has an article or main element, the text is
looked for inside it.  Names say nothing about html, body, article and main
elements themselves, nor about a wrapper (or form) that holds the page's article or, on a
page without one, most of its text.  Articles in such wrappers are left out only beside
an article outside of them (comments and teasers are often article elements too).

A page is read in time linear in its length, whatever its markup.  Counts are
map-side combined sums; no page, host or tree is gathered in a task.
"""

from __future__ import annotations

import functools
import html as entities
import os
import re
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns
from tessera.session import checkpoint_dir

MIN_PAGES = 5
LOW, GOOD = 0.2, 0.6
ENOUGH, MIN_GAP, MINOR = 40, 0.05, 0.2  # pages of a host, width of the gap, share of the text under it

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z]+")

# HTML's own element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title xmp noframes".split())  # no tags inside
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul caption""".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table menu dir".split())

# Names that mark something other than the main text.
NOISE_TAGS = frozenset("head nav footer aside button menu dialog fieldset noscript template svg math object canvas select".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent contentinfo complementary cookie cookies copyright dialog discussion disqus footer form gdpr login menu modal
nav navbar navigation newsletter notice notices pager pagination popup promo promotion promoted recommended related
replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
STATES = frozenset("has have with without no not is".split())  # "with-comments" names what the element has, not what it is
ARTICLE = frozenset(("article", "main"))
UNNAMED = ARTICLE | {"html", "body"}  # never noise by name
BY_NAME, SURE = 1, 2  # noise unless it holds the page's article; noise whatever it holds


def attributes_of(attributes: str) -> dict[str, str]:
    """Value ('' if none) of each attribute, the first of a name as in HTML."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        out.setdefault(name.lower(), a or b or c)
    return out


@functools.lru_cache(maxsize=8192)
def _open(tag: str, attributes: str, in_article: bool) -> tuple[str, int]:
    """Label of an element in the style tree, and whether it is noise (0, BY_NAME, SURE)."""
    given = attributes_of(attributes) if attributes else {}
    parts, named = [], set()
    for name in ("class", "id", "role"):
        for token in given.get(name, "").lower().split():
            own = _PART.findall(token)
            parts += own
            named.update(p for before, p in zip([None, *own], own) if before not in STATES)
    label = f"{tag}.{'.'.join(sorted(set(parts)))}" if parts else tag
    if tag in ("html", "body"):
        return label, 0
    if (tag in NOISE_TAGS or not in_article and tag == "header" or "hidden" in given
            or given.get("aria-hidden", "").strip().lower() == "true"
            or _NO_DISPLAY.search(given.get("style", "")) is not None):
        return label, SURE
    by_name = tag == "form" or tag not in UNNAMED and (
        not NOISE_WORDS.isdisjoint(named) or not in_article and not HEADER_WORDS.isdisjoint(named))
    return label, BY_NAME if by_name else 0


def tags_of(page: str):
    """(start, end, name, closing, attributes) of each tag; name '' for a comment
    or declaration.  A tag ends at the next > outside quotes; a quote that never
    closes is a character like any other, and once a tag would not end at all
    quotes mean nothing in the rest of the page.  Each place is read a bounded number of times."""
    at, quotes, last = 0, True, page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, "", False, ""
            continue
        m = _NAME.match(page, start)
        if m is None and not page.startswith(("<!", "<?"), start):
            at = start + 1
            continue
        if start > last:
            return
        i = m.end() if m else start + 2
        if m is None or not quotes:
            end = page.find(">", i)
        else:
            end = i
            while True:
                stop = _STOP.search(page, end)
                if stop is None:
                    end, quotes = page.find(">", i), False
                    break
                end = stop.start()
                if stop[0] == ">":
                    break
                close = page.find(stop[0], end + 1)
                if close < 0:
                    end, quotes = page.find(">", i), False
                    break
                end = close + 1
        at = end + 1 if end >= 0 else len(page)
        yield (start, at, m[2].lower(), bool(m[1]), page[i:at - 1]) if m else (start, at, "", False, "")


def all_blocks(page: str | None) -> list[tuple[int, int, int, int, str]]:
    """(style node, place, noise, noisy element, text) of every block of the page.

    The node is a hash of the tags and classes from the root.  The place is 0
    outside article and main elements, else 2 * n + 1 in a main and 2 * n + 2 in an
    article element, n: wrappers of noisy names around it that an article or main
    element was found in.  The noisy element is the number of the outermost one
    that a name marks (0: none)."""
    out: list[tuple[int, int, int, int, str]] = []
    stack: list[tuple] = []  # tag, node, noise, place, noisy element
    open_at: dict[str, list[int]] = {}  # places of a tag's open elements in the stack
    text: list[str] = []
    page, read, count = page or "", 0, 0
    path, noise, inside, named = 0, 0, 0, 0

    def flush():
        if text:
            s = " ".join(entities.unescape("".join(text)).split())
            if s:
                out.append((path, inside, noise, named, s))
            text.clear()

    def pop_to(n):
        nonlocal path, noise, inside, named
        for t in stack[n:]:
            open_at[t[0]].pop()
        del stack[n:]
        _, path, noise, inside, named = stack[-1] if stack else ("", 0, 0, 0, 0)

    def innermost(tags, stops):
        """Place of the innermost open element of ``tags`` with none of ``stops`` inside it."""
        i = max((open_at[t][-1] for t in tags if open_at.get(t)), default=-1)
        if i >= 0 and any(open_at[t][-1] > i for t in stops if open_at.get(t)):
            return -1
        return i

    skip = 0  # end of a raw element's content
    for start, end, tag, closing, attributes in tags_of(page):
        if start < skip:
            continue
        if start > read:
            text.append(page[read:start])
        read = end
        if not tag:
            continue
        if closing:
            if tag in RAW:
                continue
            i = innermost((tag,), () if tag in ARTICLE or tag in ("body", "html") else ARTICLE)
            if tag in BLOCK:
                flush()
            if i >= 0:
                if any(s[0] in BLOCK or s[2] for s in stack[i:]):
                    flush()
                pop_to(i)
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, end)
            skip = read = close.start() if close else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and (i := innermost(("p",), BLOCK - {"p"})) >= 0:
                pop_to(i)
            if tag in SAME and (i := innermost(SAME[tag], LISTS)) >= 0:
                pop_to(i)
        label, own = _open(tag, attributes, inside > 0)
        if tag in BLOCK or own:
            if own and tag not in BLOCK:
                flush()
            path = node(path, label)
        if tag in ARTICLE:
            wrapped = max(inside - 1, 0) // 2
            if noise == BY_NAME:
                noise, wrapped, named = 0, wrapped + 1, 0
            inside = max(inside, 2 * wrapped + (2 if tag == "article" else 1))
        if own == BY_NAME and not named:
            count += 1
            named = count
        noise = max(noise, own)
        open_at.setdefault(tag, []).append(len(stack))
        stack.append((tag, path, noise, inside, named))
    if read < len(page):
        text.append(page[read:])
    flush()
    return out


def main_blocks(found: list[tuple[int, int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(node, place, text) of the blocks outside noise.  What a name alone marks
    is no noise on a page without article elements if it holds most of the page's
    text: a page of search results or inside one form is the page itself."""
    plain = [b for b in found if b[2] < SURE]
    keep: set[int] = set()
    if any(b[3] for b in plain) and not any(b[1] for b in plain):
        size: dict[int, int] = {}
        for b in plain:
            size[b[3]] = size.get(b[3], 0) + len(b[4])
        most = max(size, key=lambda k: (size[k], -k))
        if most and 2 * size[most] > sum(size.values()):
            keep = {most}
    return [(b[0], b[1], b[4]) for b in plain if b[2] == 0 or b[3] in keep]


def blocks(page: str | None) -> list[tuple[int, int, str]]:
    """(style node, place, text) of the page's blocks outside noise, in page order."""
    return main_blocks(all_blocks(page))


def node(parent: int, label: str) -> int:
    """Node of the style tree: a hash of its parent and its label."""
    import xxhash
    return xxhash.xxh64_intdigest(label, parent & (1 << 64) - 1) - (1 << 63)


def text_hash(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def relevant(found: list[tuple[str, int, str]]) -> list[tuple[str, int, str]]:
    """Blocks inside article or main elements if the page has any there, up to
    the place of its least wrapped article (main element if it has no article)."""
    places = {b[1] for b in found if b[1]}
    if not places:
        return found
    last = min((p for p in places if p % 2 == 0), default=min(places))
    return [b for b in found if 0 < b[1] <= last]


def style_rows(page: str | None) -> list[tuple[int, int, int, int]]:
    """Distinct (node, kind, hash, size) of the whole page, menus and footers
    included: kind 0 a text of the node with its length, 1 its presentation (the nodes before it)."""
    found = all_blocks(page)
    rows = {(b[0], 0, text_hash(b[4]), len(b[4])) for b in found}
    previous = 0
    looks: dict[int, set] = {}
    for b in found:
        looks.setdefault(b[0], set()).add(previous)
        previous = b[0]
    rows |= {(k, 1, text_hash(" ".join(map(str, sorted(x)))), 0) for k, x in looks.items()}
    return sorted(rows)


def style_trees(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance, size) of the merged trees, from (host, html)."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = [(h, *r) for h, t in zip(b.column(0).to_pylist(), b.column(1)) for r in style_rows(t.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5,
                                                (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["host", "node", "kind", "hash", "size"])

    rows = pages.select("host", "html").mapInArrow(run, "host string, node long, kind int, hash long, size long")
    each = rows.groupBy("host", "node", "kind", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    n = F.col("n").cast("double")
    per = each.groupBy("host", "node", "kind").agg(F.sum(n).alias("total"), F.sum(n * F.log(n)).alias("nlogn"), F.sum("size").alias("size"))
    text, look = (lambda c: F.max(F.when(F.col("kind") == 0, F.col(c)))), (lambda c: F.max(F.when(F.col("kind") == 1, F.col(c))))
    nodes = per.groupBy("host", "node").agg(text("total").alias("t"), text("nlogn").alias("tl"), look("total").alias("pages"),
                                            look("nlogn").alias("pl"), F.sum("size").alias("size"))
    scale = F.log(F.col("pages"))
    content = 1 - F.col("tl") / F.col("t") / scale
    presentation = 1 - F.col("pl") / F.col("pages") / scale
    return nodes.select("host", "node", F.col("pages").cast("long").alias("pages"),
                        F.when(F.col("pages") < 2, F.lit(1.0)).otherwise(
                            F.greatest(content, presentation / 2)).alias("importance"), "size")


def low_branches(trees: DataFrame, min_pages: int = MIN_PAGES, enough: int = ENOUGH) -> DataFrame:
    """(host, drop: array of nodes) of hosts with nodes to leave out."""
    seen = trees.where(F.col("pages") >= min_pages)
    best = seen.groupBy("host").agg(F.max("importance").alias("best"))
    plain = seen.join(best.where(F.col("best") >= GOOD), "host").where(F.col("importance") < LOW).select("host", "node")
    # the widest gap between neighbours in order of importance, over which nearly all of the text lies
    in_order = Window.partitionBy("host").orderBy("importance", "node")
    often = trees.where(F.col("pages") >= enough)
    steps = often.select("host", "importance", F.lag("importance").over(in_order).alias("under"), F.sum("size").over(
        in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("below"), F.sum("size").over(Window.partitionBy("host")).alias("all"))
    gap = F.col("importance") - F.col("under")
    cut = steps.groupBy("host").agg(F.max_by(F.struct("importance", gap.alias("gap"), "below", "all"), gap).alias("c"))
    cut = cut.where((F.col("c.gap") >= MIN_GAP) & (F.col("c.below") <= MINOR * F.col("c.all"))).select("host", F.col("c.importance").alias("least"))
    under = often.join(cut, "host").where(F.col("importance") < F.col("least")).select("host", "node")
    return plain.unionByName(under).groupBy("host").agg(F.collect_set("node").alias("drop"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per input row: page_id, url, text (blocks joined by two \\n), n_chars.

    A null html is the empty page with text ''.  Pages whose url is null or names
    no host share no style tree: only tags and names decide.  Repeated rows
    count as pages of their own and give repeated results; an empty table
    gives no rows.  A host's low nodes are joined to its pages; Spark broadcasts that
    table if its files are small and else joins with skew splitting.
    """
    spark = pages.sparkSession
    p = columns(pages, page_id=page_id, url=url, html=html).withColumn(
        "host", F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)))
    low = low_branches(style_trees(p.where("host <> ''")), min_pages)
    path = os.path.join(checkpoint_dir(spark), f"style-trees-{uuid.uuid4().hex}")
    low.write.parquet(path)  # known size: the planner sees whether it may be broadcast
    joined = p.join(spark.read.schema(low.schema).parquet(path).withColumnRenamed("host", "_host"),
                    F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "drop")
    kind = p.schema["page_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = []
            for h, drop in zip(b.column(2), b.column(3).to_pylist()):
                found = relevant(blocks(h.as_py()))
                if drop:
                    gone = set(drop)
                    found = [x for x in found if x[0] not in gone]
                texts.append("\n\n".join(x[2] for x in found))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
