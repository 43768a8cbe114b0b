"""Main text of pages by union-free wrapper inference.

Pages of a host come from templates.  A wrapper is a union-free regular
expression over tags: a sequence of items, each optional (?) or repeated (+),
with text slots.  It is inferred by aligning page after page with what is
known so far: an item that a page lacks becomes optional, one that occurs again
becomes repeated, a text that differs becomes a variable slot, and a text that
is the same on pages whose main text differs belongs to the template.

The fold is distributed: each task folds its pages by host, partial wrappers
are folded again in two streamed rounds (first within a part of a host, then
per host), so a host with a third of all pages meets in one task only as a few
small wrappers.  A wrapper is then joined to its host's pages and decides which
of their slots are main text.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwise.llm.common import bounded_batches, free_worker, slices, stage, to_batch

# HTML element names by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math xmp noframes object select".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
             "p pre search section summary table tbody td tfoot th thead tr ul".split())
CHROME = set("aside button dialog footer form head label menu nav noscript script search select style "
             "svg template textarea title iframe math object xmp noframes input option fieldset".split())
CHROME_ROLES = set("navigation complementary contentinfo banner search dialog alert menu menubar form".split())
CHROME_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
                   "consent gdpr notice notices notification alert banner comment comments commentlist disqus reply "
                   "replies respond sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs footer "
                   "foot masthead topbar header related recommended share sharing social newsletter subscribe "
                   "subscription signup login popup modal overlay widget pager pagination toolbar skip".split())
# a start tag that closes an open element of these kinds
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
P = {"p"}
# words for the frame of a page, which may enclose its main text; the others mark text of their own
FRAME_WORDS = set("sidebar side menu nav navbar navigation header topbar masthead notice notices banner widget share "
                  "sharing social newsletter cookie cookies consent modal overlay skip toolbar".split())
DENIALS, OWN_PARTS = set("no not without non".split()), set("post entry article story content".split())
HEADS = set("header headline foot".split())
DOUBTFUL = set("side share foot skip reply alert notice related".split())
PARTNERS = set("bar bars button buttons link links icon icons list widget column col left right posts articles "
               "nav menu cookie site page global to form block panel section area stories reading content".split())
SCOPES = set("html body article aside section nav main header footer form div ul ol dl table td th blockquote "
             "figure details".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
                   re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

MAX_ITEMS = 64
#: Distinct main texts a slot must be seen with before sameness says something.
LEAST_PAGES = 3
#: Blocks of so many characters tell main texts apart; where a page has none, all do.
LONG_BLOCK = 60
#: Hosts a task folds at a time.
OPEN_HOSTS = 2_000


class Node:
    __slots__ = ("tag", "label", "chrome", "words", "items")

    def __init__(self, tag: str, label: str, chrome: bool, words: frozenset[str] = frozenset()):
        self.tag, self.label, self.chrome, self.words = tag, label, chrome or bool(words), words
        self.items: list[Node | str] = []


@lru_cache(1 << 16)
def _says(name: str) -> frozenset[str]:
    """The words of one class name that say what an element is.  A name that
    denies ("no-sidebar"), compares ("side-by-side") or speaks of the article's
    own parts ("post-header") says nothing; words with another meaning too
    ("share-price") need a partner that tells which is meant."""
    words = [w.lower() for w in WORD.findall(name)]
    if not words or words[0] in DENIALS or "by" in words or words[0] in OWN_PARTS and len(words) > 1 and words[-1] in HEADS:
        return frozenset()
    alone = len(words) == 1 or any(w in PARTNERS for w in words)
    return frozenset(w for w in words if alone or w not in DOUBTFUL)


def _element(tag: str, attributes: str) -> Node:
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    names = f"{found.get('class', '')} {found.get('id', '')}"
    role = found.get("role", "").lower()
    parts = set().union(*map(_says, names.split()))
    chrome = tag in CHROME or role in CHROME_ROLES or "hidden" in attributes.lower().split()
    # the words that alone make it chrome
    words = parts & CHROME_WORDS if not chrome and tag not in ("html", "body", "article", "main") else ()
    mark = ".".join(sorted(re.sub(r"\d+", "#", w) for w in names.split())[:3])
    return Node(tag, f"{tag}.{mark}" if mark else tag, chrome, frozenset(words))


def parse(html: str) -> Node:
    """Tree of a page, however deep; unclosed and stray tags are put up with."""
    root = Node("root", "root", False)
    stack, at = [root], 0
    # numbers of open elements by tag, of the whole stack and of each open scope
    every: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]
    unclosed: set[str] = set()

    def text(chunk: str) -> None:
        if chunk:
            stack[-1].items.append(html_lib.unescape(chunk) if "&" in chunk else chunk)

    def close(tags: set[str]) -> None:
        """Up to the innermost open element of these tags."""
        tag = None
        while tag not in tags:
            tag = stack.pop().tag
            every[tag] -= 1
            if tag in SCOPES:
                scopes.pop()
            else:
                scopes[-1][tag] -= 1

    n = len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            # a stray end tag does not close its surroundings
            if (every if tag in SCOPES else scopes[-1])[tag]:
                close({tag})
            continue
        closed = CLOSES.get(tag) or (P if tag in BLOCKS else ())
        if any(scopes[-1][t] for t in closed):
            close(closed)
        node = _element(tag, m[3])
        stack[-1].items.append(node)
        shut = m[3].endswith("/")
        if tag in RAW:
            if shut and tag in ("svg", "math"):
                continue
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                at = n
            else:  # only the tag is dropped
                unclosed.add(tag)
        elif tag not in VOID and not shut:
            stack.append(node)
            every[tag] += 1
            if tag in SCOPES:
                scopes.append(Counter())
            scopes[-1][tag] += 1
    _free_regions(root)
    return root


def _free_regions(root: Node) -> None:
    """A class word does not make chrome of what holds the page's main region:
    a main element, or the articles if all of them lie in frames."""
    # per region: its tag and the elements around it that are chrome, or None if one is so by more than a frame word
    found: list[tuple[str, list[Node] | None]] = []
    todo: list[tuple[Node, list[Node] | None]] = [(root, [])]
    while todo:
        node, around = todo.pop()
        if node.tag in ("article", "main") and not (node.chrome and not node.words):
            found.append((node.tag, around))
            if node.tag == "main" or around == []:
                continue
        if node.chrome and around is not None:
            around = [*around, node] if node.words and node.words <= FRAME_WORDS else None
        todo += [(child, around) for child in node.items if not isinstance(child, str)]
    if any(around == [] for _, around in found):
        return
    framed = [(tag, around) for tag, around in found if around]
    for tag, around in framed:
        if tag == "main" or not any(t == "main" for t, _ in framed):
            for node in around:
                node.chrome = False


# ---- wrappers --------------------------------------------------------------------
# A wrapper item: the keys of its pages' main texts (the LEAST_PAGES smallest: copies
# count once, however they are dealt over tasks), opt and rep flags, chrome flag, the
# text slot ([hash of the only text or None, characters, of them in links]) and items
# by label, in order of first appearance.
def _item(chrome: bool, key: int) -> dict:
    return {"keys": [key], "opt": False, "rep": False, "chrome": chrome, "slot": None, "items": {}}


def content_key(root: Node) -> int:
    """Hash of a page's text outside chrome.  Words with digits and, beside
    long blocks, short ones are left out: a date or a nonce makes no new text."""
    blocks = extract(root, None).split("\n")
    said = [" ".join(w for w in b.split() if w.isalpha() or not any(map(str.isdigit, w)))
            for b in [b for b in blocks if len(b) >= LONG_BLOCK] or blocks]
    return xxhash.xxh32_intdigest("\n".join(said).encode("utf-8", "surrogatepass"))


def wrap(root: Node, key: int | None = None) -> dict:
    """The wrapper of one page: equal neighbours are squared into repeats."""
    key = content_key(root) if key is None else key
    top = _item(root.chrome, key)
    # open elements: element, in a link, its item, its children left, own text
    todo = [(root, False, top, iter(root.items), [])]
    while todo:
        node, linked, w, left, own = todo[-1]
        for child in left:
            if isinstance(child, str):
                own.append(child)
            elif child.label not in RAW:
                todo.append((child, linked or child.tag == "a", _item(child.chrome, key), iter(child.items), []))
                break
        else:
            todo.pop()
            said = " ".join(" ".join(own).split())
            if said:
                w["slot"] = [xxhash.xxh3_64_intdigest(said), len(said), len(said) if linked else 0]
            if todo:
                items = todo[-1][2]["items"]
                label = node.label if node.label in items or len(items) < MAX_ITEMS else node.tag
                if label in items:
                    fold(items[label], w, same_page=True)
                else:
                    items[label] = w
    return top


def fold(a: dict, b: dict, same_page: bool = False) -> dict:
    """Align ``b`` with ``a``, in place."""
    todo = [(a, b)]
    for x, y in todo:  # grows
        _align(x, y, same_page, todo)
    return a


def _align(a: dict, b: dict, same_page: bool, todo: list[tuple[dict, dict]]) -> None:
    a["opt"] |= b["opt"]
    a["rep"] |= b["rep"] or same_page
    a["chrome"] &= b["chrome"]
    if a["keys"] != b["keys"]:
        a["keys"] = sorted({*a["keys"], *b["keys"]})[:LEAST_PAGES]
    if a["slot"] and b["slot"]:
        same = a["slot"][0] == b["slot"][0] and not same_page
        a["slot"] = [a["slot"][0] if same else None, a["slot"][1] + b["slot"][1], a["slot"][2] + b["slot"][2]]
    elif b["slot"]:
        a["slot"] = list(b["slot"])
    for label, item in a["items"].items():
        if label not in b["items"]:
            item["opt"] = True
    for label, item in b["items"].items():
        if label not in a["items"] and len(a["items"]) >= MAX_ITEMS:
            label = label.split(".")[0]
        if label in a["items"]:
            todo.append((a["items"][label], item))
        else:
            item["opt"] = True
            a["items"][label] = item


def dump(w: dict) -> str:
    """A wrapper as a flat JSON list: the items by rank, each with the place of the one around it."""
    rows, todo = [], [(None, "", w)]
    for at, (around, label, item) in enumerate(todo):  # grows
        rows.append([around, label, *[item[k] for k in ("keys", "opt", "rep", "chrome", "slot")]])
        todo += [(at, name, i) for name, i in item["items"].items()]
    return json.dumps(rows, separators=(",", ":"))


def load(text: str) -> dict:
    items = []
    for around, label, *values in json.loads(text):
        items.append({**dict(zip(("keys", "opt", "rep", "chrome", "slot"), values)), "items": {}})
        if around is not None:
            items[around]["items"][label] = items[-1]
    return items[0]


def expression(w: dict, label: str = "page") -> str:
    """The wrapper as a union-free regular expression."""
    inner = []
    if w["slot"]:
        inner.append("#same" if w["slot"][0] is not None and len(w["keys"]) >= LEAST_PAGES else "#text")
    inner += [expression(item, name) for name, item in w["items"].items()]
    mark = "*" if w["opt"] and w["rep"] else "?" if w["opt"] else "+" if w["rep"] else ""
    return f"{label}({' '.join(inner)}){mark}"


def _regions(w: dict, tag: str) -> Iterator[dict]:
    todo = [w]
    while todo:
        for label, item in todo.pop()["items"].items():
            if item["chrome"]:
                continue
            if label.split(".")[0] == tag:
                yield item
            else:
                todo.append(item)


def _amount(w: dict) -> int:
    """Characters of variable text outside links in a region."""
    own, todo = 0, [w]
    while todo:
        w = todo.pop()
        if w["slot"] and not _template(w):
            own += w["slot"][1] - w["slot"][2]
        todo += [i for i in w["items"].values() if not i["chrome"]]
    return own


def _template(w: dict) -> bool:
    """The slot holds the same text on every page, and their main texts differ."""
    return bool(w["slot"]) and w["slot"][0] is not None and len(w["keys"]) >= LEAST_PAGES and not w["rep"]


def region_tag(w: dict) -> str | None:
    """The element that holds this host's main text, if it marks one."""
    for tag in ("article", "main"):
        if any(_amount(r) for r in _regions(w, tag)):
            return tag
    return None


# ---- extraction ------------------------------------------------------------------
def extract(root: Node, wrapper: dict | None) -> str:
    """Main text of a page: the blocks of its main region, without template
    slots and chrome, each on one line.  Where nothing else is said, template
    slots stay."""
    tag = region_tag(wrapper) if wrapper else None
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        said = " ".join("".join(line).split())
        if said:
            blocks.append(said)
        line.clear()

    if tag and not _has_tag(root, tag):
        tag = next((t for t in ("article", "main") if t != tag and _has_tag(root, t)), None)

    def opened(node: Node, item: dict | None, inside: bool) -> tuple:
        if node.tag in BLOCKS:
            end()
        # outside a marked region, what every page of the host says is template
        fixed = not tag and item is not None and _template(item)
        links = not tag and item is not None and item["slot"] and item["slot"][2] * 2 > item["slot"][1] \
            and node.tag == "a" and item["rep"]
        return node, item, inside, inside and not fixed and not links, iter(node.items)

    todo = [opened(root, wrapper, tag is None)]
    while todo:
        node, item, inside, said, left = todo[-1]
        for child in left:
            if isinstance(child, str):
                if said:
                    line.append(child)
                continue
            if child.tag == "br":
                line.append(" ")
            if child.chrome or child.tag in RAW:
                if child.tag in BLOCKS:
                    end()
                continue
            below = item["items"].get(child.label) or item["items"].get(child.tag) if item else None
            todo.append(opened(child, below, inside or child.tag == tag))
            break
        else:
            todo.pop()
            if node.tag in BLOCKS:
                end()
    end()
    return "\n".join(blocks) if blocks or not wrapper else extract(root, None)


def _has_tag(root: Node, tag: str) -> bool:
    todo = [root]
    while todo:
        below = [c for c in todo.pop().items if not isinstance(c, str) and not c.chrome]
        if any(c.tag == tag for c in below):
            return True
        todo += below
    return False


# ---- Spark -----------------------------------------------------------------------
_FOLDED = pa.schema([("host", pa.string()), ("part", pa.int32()), ("wrapper", pa.string())])
_FOLDED_DDL = "host string, part int, wrapper string"


def _emit(open_: dict[str, dict], part: int) -> pa.RecordBatch:
    return to_batch({"host": list(open_), "part": [part] * len(open_),
                     "wrapper": [dump(w) for w in open_.values()]}, _FOLDED)


def infer_wrappers(pages: DataFrame, parts: int = 64) -> DataFrame:
    """host, wrapper (JSON) of pages (host, html); pages of one main text count once."""

    def first(batches):
        free_worker()
        open_, seen, part = {}, set(), TaskContext.get().partitionId() % parts
        for hosts, htmls in slices(batches):
            for host, html in zip(hosts, htmls):
                key = xxhash.xxh3_64_intdigest(html.encode("utf-8", "surrogatepass") + host.encode())
                if key in seen:
                    continue
                if len(seen) < 1_000_000:  # copies beyond only add characters
                    seen.add(key)
                w = wrap(parse(html))
                if host in open_:
                    fold(open_[host], w)
                else:
                    open_[host] = w
                if len(open_) >= OPEN_HOSTS:
                    yield _emit(open_, part)
                    open_ = {}
        yield _emit(open_, part)

    def again(batches):  # rows come sorted by host: one wrapper is open at a time
        open_: dict[str, dict] = {}
        for b in batches:
            for host, part, w in zip(*[c.to_pylist() for c in b.columns]):
                if open_ and (host, part) != held:
                    yield _emit(open_, held[1])
                    open_ = {}
                held = (host, part)
                if host in open_:
                    fold(open_[host], load(w))
                else:
                    open_[host] = load(w)
        if open_:
            yield _emit(open_, held[1])

    folded = pages.select("host", "html").mapInArrow(first, _FOLDED_DDL)
    # ties: the order of a host's partial wrappers is fixed, so the fold is the same in every run
    folded = folded.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper").mapInArrow(
        again, _FOLDED_DDL)
    folded = (folded.withColumn("part", F.lit(0)).repartition("host")
              .sortWithinPartitions("host", "wrapper").mapInArrow(again, _FOLDED_DDL))
    return folded.select("host", "wrapper")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages (page_id, url, html).

    Null or empty html gives an empty text; a null or odd url puts the page
    under the empty host.  Rows that repeat are extracted each.  Nothing is
    cut off.  Other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                        F.coalesce(host, F.lit("")).alias("host"))
    wrappers = stage(infer_wrappers(rows), "html-wrappers")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        known: tuple[str | None, dict | None] = (None, None)
        for ids, htmls, urls, ws in slices(batches):
            out = {f.name: [] for f in schema}
            for page_id, html, url, w in zip(ids, htmls, urls, ws):
                if w != known[0]:
                    known = (w, load(w) if w else None)
                text = extract(parse(html), known[1])
                for values, v in zip(out.values(), (page_id, url, text, len(text))):
                    values.append(v)
            yield to_batch(out, schema)

    return (rows.join(wrappers, "host", "left").select("page_id", "html", "url", "wrapper")
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
