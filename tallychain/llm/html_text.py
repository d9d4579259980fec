"""Main text of web pages: one template a host, deduced from all its pages, and text taken from the slots it leaves."""

import json
import re
from collections import Counter, defaultdict
from hashlib import blake2b
from html import unescape

import pandas as pd
from pyspark.sql import functions as F

from tallychain.llm.texts import settled, sized_broadcast

#: Pages whose tokens are handed on at once.  It does not change results.
GROUP = 64
#: Least share of a host's articles that have a token of its template.
SUPPORT = 0.3
#: A text is template if at least so many articles, and this share of those with its element, have it.
SHARED, SHARE = 4, 0.7
#: What text under an element with a doubtful name counts for when slots are weighed.
DOUBT = 0.25

# Elements of HTML by their rules.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body dd dt head html legend li option select tbody td tfoot th thead tr".split())
CONTAINERS = frozenset("html body main article section div table tbody tr td center form".split())
# Elements without text of the page; and elements and words of class, id and role that often name what is not the article.
OUTSIDE = frozenset("head script style noscript template button select textarea iframe svg object canvas title".split())
DOUBTFUL = frozenset("nav footer aside form menu dialog".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo banner nav navbar navigation navigator menu menubar "
    "topbar breadcrumb breadcrumbs sidebar aside footer masthead contentinfo complementary comment comments commentlist "
    "disqus replies respond cookie cookies consent gdpr notice notices alert toolbar newsletter subscribe signup login "
    "share sharing pagination pager popup modal".split()
)
# Names that parts of articles have as well: with links for most of their text only.
VAGUE = frozenset("promotion rail foot reply discussion subscription search social related recommended recommendations widget overlay skip".split())
HEADER_NAMES = frozenset("header head pageheader siteheader".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[^<]?[^<]*|[^<]+", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
_NUMBER, _LONG_NUMBER = re.compile("[0-9]+"), re.compile("[0-9]{3,}")


class Node:
    __slots__ = ("tag", "path", "outside", "doubtful", "parent", "link", "mass", "length", "light")

    def __init__(self, tag, path, outside, doubtful, parent, link):
        self.tag, self.path, self.outside, self.doubtful, self.parent, self.link = tag, path, outside, doubtful, parent, link
        self.mass, self.length, self.light = 0, 0, False


def _above(node):
    """A node and its ancestors, without the root."""
    while node is not None and node.parent is not None:
        yield node
        node = node.parent


def _outside(tag, attributes):
    """Whether an element is never shown as text of the page."""
    if tag in OUTSIDE:
        return True
    if "hidden" in attributes:
        return tag not in ("html", "body")
    if tag in ("html", "body", "article", "main"):
        return False
    return attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _doubtful(tag, attributes, parent):
    """Whether an element's tag or names are those of what often is no part of an article; None: it is if links fill most of it."""
    if tag in DOUBTFUL:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    words = set(_SPLIT.split(" ".join(attributes.get(k) or "" for k in ("class", "id", "role")).lower()))
    header = tag == "header" or bool(words & HEADER_NAMES)
    if words & NAMES or header and not any(n.tag in ("article", "main") for n in _above(parent)):
        return True
    return None if words & VAGUE else False


def _mark(tag, attributes):
    """What names an element in a path: tag, classes and id, without what may stand for one page.

    Numbers in an id and numbers of three digits or more in a class become 0; an id of more than three
    words, such as a title, is left out.
    """
    classes = sorted({_LONG_NUMBER.sub("0", w) for w in (attributes.get("class") or "").split()})
    name = attributes.get("id") or ""
    name = "" if len(_SPLIT.split(name.lower().strip("-_"))) > 3 else _NUMBER.sub("0", name)
    return "".join([tag, *("." + w for w in classes), "#" + name if name else ""])


def parse(html):
    """(nodes, blocks) of a page: elements in order of their start, and blocks (text, innermost block node, characters in links) in page order.

    An element with a doubtful name is ``light`` if it holds less than half of the page's text
    outside links; a name alone never stands against the element that holds most of the text.
    """
    nodes, blocks, buffer = [], [], []
    stack = [Node("", "", False, False, None, False)]
    holder, linked = stack[0], 0

    def flush():
        nonlocal linked
        text = _SPACE.sub(" ", "".join(buffer)).strip()
        if text:
            blocks.append((text, holder, min(linked, len(text))))
        buffer.clear()
        linked = 0

    def pop_to(index):
        if any(n.tag in BLOCK for n in stack[index:]):
            flush()
        del stack[index:]

    def close(tags, barrier):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                pop_to(i)
                return
            if stack[i].tag in barrier:
                return

    at, end = 0, len(html)
    match = _TOKEN.match
    while at < end:
        m = match(html, at)
        at = m.end()
        name = m[2]
        if name is None:
            text = m[0]
            if text[0] != "<" or not (text.startswith("<!") or text.startswith("<?")) and not (text[1:2] == "/" or text[1:2].isalpha()):
                if not stack[-1].outside:
                    if not buffer or holder is not _block(stack):
                        if buffer and not "".join(buffer).isspace():
                            flush()
                        holder = _block(stack)
                    piece = unescape(text)
                    buffer.append(piece)
                    if stack[-1].link:
                        linked += len(piece)
            continue
        tag = name.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
            else:
                if tag in BLOCK:
                    flush()
            continue
        if tag in CLOSES_P:
            close({"p"}, {"button", "table", "td", "th", "caption", "object"})
        if tag == "li":
            close({"li"}, {"ul", "ol", "menu"})
        elif tag in ("dd", "dt"):
            close({"dd", "dt"}, {"dl"})
        elif tag in ("td", "th"):
            close({"td", "th"}, {"tr", "table"})
        elif tag == "tr":
            close({"tr"}, {"table"})
        elif tag == "option":
            close({"option"}, {"select"})
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            pop_to(len(stack) - 1)
        elif tag == "body":
            close({"head"}, set())
        if tag in BLOCK:
            flush()
        if tag == "br":
            buffer.append(" ")
        if tag in VOID:
            continue
        attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(m[3])} if m[3].strip(" /\n\t\r") else {}
        parent = stack[-1]
        node = Node(tag, f"{parent.path}>{_mark(tag, attributes)}", parent.outside or _outside(tag, attributes), _doubtful(tag, attributes, parent), parent, parent.link or tag == "a")
        if not node.outside:
            nodes.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            at = stop.start() if stop else end
            stack.append(node)
            continue
        if not m[3].rstrip().endswith("/") or tag not in ("svg", "path"):
            stack.append(node)
    flush()
    blocks = [b for b in blocks if not b[1].outside]
    for text, holder, linked in blocks:
        for node in _above(holder):
            node.mass += len(text) - linked
            node.length += len(text)
    total = sum(len(text) - linked for text, _, linked in blocks)
    for node in nodes:
        doubtful = 2 * node.mass < node.length if node.doubtful is None else node.doubtful
        node.light = doubtful and 2 * node.mass < total
    return nodes, blocks


def _block(stack):
    for node in reversed(stack):
        if node.tag in BLOCK or node.parent is None:
            return node
    return stack[0]


#: The token that every page has.
ROOT = 0


def token(*parts):
    """64 bits that stand for a path, or for a text at a path."""
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 1


def article_of(blocks):
    """What near copies of a page have in common: the longest blocks, as many as hold half of its text."""
    left, held = sum(len(text) for text, _, _ in blocks) / 2, []
    for text in sorted((text for text, _, _ in blocks), key=lambda t: (-len(t), t)):
        if left <= 0:
            break
        held.append(text)
        left -= len(text)
    return token(*sorted(held))


def tokens_of(page):
    """{token: [occurrences, mass]} of a page: its elements by path, its texts by path and text, and the root.

    Mass is the text outside links under an element; text under doubtful names counts less.
    """
    nodes, blocks = page
    named = {}
    for path, n in Counter(node.path for node in nodes).items():
        named[path] = [token(path), n, 0.0]
    texts, total = {}, 0.0
    for text, holder, linked in blocks:
        above = list(_above(holder))
        mass = (len(text) - linked) * (DOUBT if any(n.light for n in above) else 1)
        total += mass
        for node in above:
            named[node.path][2] += mass
        at = texts.setdefault((holder.path, text), [0, 0.0])
        at[0] += 1
        at[1] += mass
    found = {t: [n, mass] for t, n, mass in named.values()}
    found |= {token(path, text): at for (path, text), at in texts.items()}
    found[ROOT] = [1, total]
    return found


def extract(page, template):
    """The page's article, its blocks joined by line feeds.

    ``template`` maps the tokens that enough of the host's articles have to (articles, articles
    that have it once, mass over all articles, class); None lets the page be its own template.
    Tokens with equal occurrences over all articles are one class.  What occurs once in an article
    is the frame, and each element of it a slot.  From the outermost element the way goes down to
    the slot that holds most of the text, neither link nor template, of those of the host's articles
    that have it, so a host may have several layouts; where none does, an article or main element decides, if no other slot beside it holds more.  An element
    in the slot that holds nothing but records, which are repeated elements of a class with two or
    more parts, is a slot of its own.  Paths are nested, so a class is nested by the paths of its
    members; their order among siblings does not matter to what an element holds.
    """
    nodes, blocks = page
    if template is None:
        template = {t: (1, n == 1, mass, None) for t, (n, mass) in tokens_of(page).items()}
    paths = {node.path: node for node in nodes}
    known = {path: template[t] for path in paths if (t := token(path)) in template}
    fixed, mass = set(), Counter({path: k[2] for path, k in known.items()})
    among, _, total, _ = template.get(ROOT, (1, 0, 0, None))
    for path, text, holder in {(h.path, t): (h.path, t, h) for t, h, _ in blocks}.values():
        at = template.get(token(path, text))
        if at and at[0] >= SHARED and at[0] >= SHARE * known.get(path, at)[0]:
            fixed.add((path, text))
            total -= at[2]
            for node in _above(holder):
                mass[node.path] -= at[2]
    on_page = Counter(node.path for node in nodes)
    frame = [p for p, k in known.items() if on_page[p] == 1 and k[1] >= 0.9 * k[0] and paths[p].tag in CONTAINERS]
    chosen = None
    while total > 0:
        if chosen and paths[chosen].tag in ("article", "main"):
            break
        below = [p for p in frame if p != chosen and (chosen is None or p.startswith(chosen + ">")) and mass[p] * among >= 0.6 * total * known[p][0]]
        if not below:
            marked = [p for p in frame if paths[p].tag in ("article", "main") and (chosen is None or p.startswith(chosen + ">"))]
            best = max(marked, key=lambda p: (mass[p], p), default=None)
            apart = [mass[p] for p in frame if best and not p.startswith(best + ">") and not best.startswith(p + ">") and p != best]
            if best and mass[best] > 0 and mass[best] >= max(apart, default=0):
                chosen = best
            break
        chosen = min(below, key=lambda p: (p.count(">"), paths[p].tag not in ("article", "main"), -mass[p], p))
        total, among = mass[chosen], known[chosen][0]
    sets = _record_sets(paths, known, mass, chosen)

    def inside(holder):
        """Whether a block lies in the chosen slot, and in no other slot of it."""
        for node in _above(holder):
            if node.path == chosen:
                return True
            if node.light or node.path in sets:
                return False
        return chosen is None

    if chosen is not None:
        found = [text for text, holder, _ in blocks if (holder.path, text) not in fixed and inside(holder)]
        if found:
            return "\n".join(found)
    left = [(text, holder) for text, holder, linked in blocks if (holder.path, text) not in fixed and 2 * linked <= len(text)]
    sure = [text for text, holder in left if not any(n.light for n in _above(holder))]
    return "\n".join(sure or [text for text, _ in left] or [text for text, _, _ in blocks])


def _record_sets(paths, known, mass, chosen):
    """Paths below the chosen slot whose elements hold nothing but records, and less than half of the slot's text."""
    classes = defaultdict(list)
    for path, (n, once, _, of) in known.items():
        if of is not None and once < 0.9 * n:
            classes[of].append(path)
    found = set()
    for members in classes.values():
        for record in members:
            parts = [p for p in members if p.startswith(record + ">")]
            leaves = [p for p in parts if not any(q.startswith(p + ">") for q in parts)]
            holder = paths[record].parent.path
            if len(leaves) >= 2 and chosen and holder.startswith(chosen + ">") and mass[record] >= 0.95 * mass[holder] and 2 * mass[holder] < mass[chosen]:
                found.add(holder)
    return found


def host_of(url):
    """Host of a URL in lower case without user, port and a leading "www."; empty if there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))), r"^www\.", "")


def _templates(hosted):
    """(host, template) of hosts with two articles or more, ``template`` a JSON list of its tokens.

    Tokens are counted over all articles of a host.  They are added up by host, token and article
    first, so near copies count once and a large host is dealt over all tasks; what enough
    articles share is no more than a few pages hold, for a host of any size.
    """

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), GROUP):
                rows = []
                for host, html in zip(pdf["host"].iloc[at:at + GROUP], pdf["html"].iloc[at:at + GROUP]):
                    page = parse(html)
                    article = article_of(page[1])
                    rows += [(host, t, article, n, mass) for t, (n, mass) in tokens_of(page).items()]
                yield pd.DataFrame(rows, columns=["host", "token", "article", "n", "mass"])

    seen = hosted.select("host", "html").mapInPandas(run, "host long, token long, article long, n int, mass float")
    by_article = seen.groupBy("host", "token", "article").agg(F.max("n").alias("n"), F.max("mass").alias("mass"))
    # Equal occurrences: the sum of a hash of article and number, by halves that cannot overflow.
    key = F.xxhash64("article", "n")
    counted = by_article.groupBy("host", "token").agg(
        F.count("*").alias("articles"), F.count_if(F.col("n") == 1).alias("once"), F.sum(F.col("mass").cast("double")).alias("mass"),
        F.sum(F.shiftrightunsigned(key, 32)).alias("high"), F.sum(key.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    ).where("articles > 1").withColumn("class", F.xxhash64("high", "low"))
    counted, _ = settled(counted.select("host", "token", "articles", "once", "mass", "class"), "html-tokens")
    of_host = counted.where(F.col("token") == ROOT).select("host", F.col("articles").alias("all"))
    kept = counted.join(of_host, "host").where(F.col("articles") >= F.col("all") * SUPPORT)
    return settled(kept.groupBy("host").agg(F.to_json(F.collect_list(F.struct("token", "articles", "once", "mass", "class"))).alias("template")), "html-templates")[0]


def main_texts(pages):
    """(page_id, url, text) of every row of (page_id, url, html).

    A host has one template, deduced from all its pages; then every page is read with it.  Pages
    without a host are one more host.  Copies and near copies count once when a template is
    deduced; an article alone is its own template.  Null, empty and textless pages have an empty
    text.  Repeated rows have a row each, an empty table none.
    """
    hosted = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.xxhash64(host_of(F.col("url"))).alias("host"))
    templates = _templates(hosted)

    def run(batches):
        for pdf in batches:
            texts, read = [], {}
            for html, host, rows in zip(pdf["html"], pdf["host"], pdf["template"]):
                if host not in read:
                    read[host] = None if rows is None else {r["token"]: (r["articles"], r["once"], r["mass"], r["class"]) for r in json.loads(rows)}
                texts.append(extract(parse(html), read[host]))
            yield pdf[["page_id", "no_id", "url"]].assign(text=texts)

    rows = hosted.select(F.coalesce("page_id", F.lit(0)).alias("page_id"), F.col("page_id").isNull().alias("no_id"), "url", "html", "host")
    found = rows.join(sized_broadcast(templates, 20_000), "host", "left").mapInPandas(
        run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, no_id boolean, url string, text string"
    )
    return found.select(F.when(~F.col("no_id"), F.col("page_id")).alias("page_id"), "url", "text")
