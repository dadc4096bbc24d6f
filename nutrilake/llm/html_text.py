"""Operator 8: main text of web pages by wrapper induction.

Pages become DOM trees whose equal neighbouring siblings are folded into one
repeated node.  The trees of one host are aligned by simple tree matching into
a template that counts, per node, the pages that have it and whether its text
is the same on all of them.  The template then tells where the article of this
host's pages is (its content region) and which nodes inside it are constant,
that is, part of the template.

Scale: a node is signed by its tag and those of its class names that recur on
its host's pages (counted first), so names of single pages add no nodes.  Every
task folds its pages into one template per host, so a host with a third of all
pages adds one template per task, not its pages.  Templates grow with the
number of different layouts; they are merged per host in two steps, and a
host's is one string.  Pages meet their host's template in a join whose hot
hosts Spark can split, and are cut on their own.  Trees are walked without
recursion.  Nothing is collected.
"""
from __future__ import annotations

import html as html_lib
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import small_batches, written

# A node is the same on all pages only if at least this many different pages agree.
MIN_PAGES = 5
FLUSH_HOSTS = 2_000

# Names that mark parts of a page that are not the article.
SKIP_TAGS = frozenset(
    "head script style noscript template iframe object svg nav footer aside form button select "
    "textarea input menu dialog".split())
SKIP_WORDS = frozenset(
    "ad ads adbox advert advertisement sponsor sponsored promo banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice popup modal "
    "overlay comment comments reply replies responses discussion share social related newsletter subscribe "
    "signup login pagination pager toolbar widget".split())
# Of these, the ones that name readers' comments, and the ones that are ordinary words too: as an id they may
# name a section of the article ("discussion"), as a part of a name anything ("market-share").
COMMENT_WORDS = frozenset("comment comments reply replies response responses respond".split())
PLAIN_WORDS = frozenset("notice overlay discussion share social related consent promo reply replies".split())
STATE_WORDS = frozenset("has is no not with without".split())       # "has-sidebar" is no sidebar
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template".split())
INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split())
# An opening tag ends these open elements (HTML lets authors omit their end tags).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
        "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE_TAGS = HEADINGS | frozenset("section p li dt dd td th blockquote figure figcaption pre".split())
# A form or an element with a boilerplate word in its name that holds one of these is a wrapper of the page.
PAGE_TAGS = frozenset("main h1 nav header footer aside".split())
LISTS = frozenset("ul ol dl table body article section div".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?P<close>>|\Z)"""
    r"|(?P<text>[^<]+|<)", re.DOTALL)
NAMED = re.compile(r"(?:class|id|role)\s*=", re.IGNORECASE)     # may hold one of the attributes read here
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1|\Z)|<[a-z/!?][^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
HOLDS_MAIN = re.compile(r"""<(?:article|main)[\s/>]|\srole\s*=\s*["']?(?:article|main)\b""", re.IGNORECASE)


def attributes(attrs: str) -> dict[str, str]:
    """Attributes of a tag; the first of a name counts, values are not searched."""
    named: dict[str, str] = {}
    if NAMED.search(attrs):
        for m in ATTRIBUTE.finditer(attrs):
            named.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return named


def _part_words(names: set[str], within: int) -> bool:
    """Whether a compound name says boilerplate: by its first or last part, in articles for comments only."""
    for name in names:
        parts = re.split(r"[_-]+", name.strip("_-"))
        if len(parts) < 2 or parts[0] in STATE_WORDS:
            continue
        if parts[0] in COMMENT_WORDS:
            return True
        if within < 2 and not {parts[0], parts[-1]}.isdisjoint(SKIP_WORDS - PLAIN_WORDS):
            return True
    return False


class Node:
    """``skip``: not of the article, by its tag, its role or a whole name.  ``soft``: a form, or only a part
    of a name says so, which ``_settle`` believes unless the node holds the page.  ``within``: 2 inside an
    article element, 1 inside a main element."""

    __slots__ = ("tag", "sig", "skip", "soft", "main", "header", "within", "kids")

    def __init__(self, tag: str, attrs: str = "", known: frozenset | None = None, within: int = 0):
        named = attributes(attrs)
        kind = set(named.get("class", "").split())
        ids = {named.get("id", "").strip()} - {""}
        role = named.get("role", "")
        self.tag, self.within = tag, within
        self.sig = tag + "".join(f".{c}" for c in sorted(kind) if known is None or c in known)
        self.main = 2 if tag == "article" or role == "article" else 1 if tag == "main" or role == "main" else 0
        self.skip = self.soft = False
        page = tag in ("html", "body")
        if tag in HEADINGS:                 # a heading belongs to what it heads
            kind, ids = set(), set()
        whole = kind | (ids - PLAIN_WORDS if tag in PROSE_TAGS or self.main else ids)
        comment = self.main == 2 and any(re.split(r"[_-]", c)[0] in COMMENT_WORDS for c in kind)
        if not page and (tag in SKIP_TAGS or comment or role in SKIP_ROLES
                         or not self.main and not whole.isdisjoint(SKIP_WORDS)):
            self.soft = tag == "form" and whole.isdisjoint(SKIP_WORDS)
            if not self.soft:
                self.drop()
        plain = not page and not self.main
        if plain and not self.skip:
            self.soft |= _part_words(kind | (ids if tag not in PROSE_TAGS else set()), within)
        self.header = 0 if not plain else 2 if tag == "header" or "header" in kind | ids else \
            1 if any("header" in re.split(r"[_-]", c) for c in kind | ids) else 0
        self.kids: list = []

    def drop(self) -> None:
        """Leave the node out; it is never aligned with one that stays."""
        if not self.skip:
            self.skip = True
            self.sig += "!"


def _settle(root: Node) -> None:
    """Drop the soft nodes but those that hold an article, a part that only a page has, or all of its text."""
    order = [root]
    for node in order:
        if not node.skip:
            order += [k for k in node.kids if isinstance(k, Node)]
    holds: set[int] = set()     # nodes that hold a page's part
    text: set[int] = set()      # nodes with text outside of what is dropped
    soft: list[Node] = []
    for node in reversed(order):
        kids = [k for k in node.kids if isinstance(k, Node)]
        # a dropped article is a comment, not the page's
        if any(id(k) in holds or k.main and not k.skip or k.tag in PAGE_TAGS for k in kids):
            holds.add(id(node))
        if node.soft and id(node) not in holds:
            soft.append(node)
        elif not node.skip and (any(id(k) in text for k in kids)
                                or any(isinstance(k, str) and not k.isspace() and k for k in node.kids)):
            text.add(id(node))
    if id(root) in text:        # else the page is all in soft nodes: they stay
        for node in soft:
            node.drop()
    for node in order:          # an inline element that stays is text of its block
        if any(isinstance(k, Node) and k.tag in INLINE_TAGS and not k.skip for k in node.kids):
            node.kids = [x for k in node.kids
                         for x in (k.kids if isinstance(k, Node) and k.tag in INLINE_TAGS and not k.skip else [k])]


def parse(page: str, known: frozenset | None = None) -> Node:
    """A tolerant DOM: block elements are nodes, inline ones are transparent
    (their text belongs to the block), a tag cut off by the end is dropped.
    ``known``: the class names that sign a node; all of them if None."""
    root = Node("#root")
    stack, at, soft = [root], 0, False
    opened: dict[str, int] = {}      # open elements by tag, so that a stray end tag is not searched for

    def close(i: int) -> None:
        for n in stack[i:]:
            opened[n.tag] -= 1
        del stack[i:]

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        text = m["text"]
        if text is not None:
            stack[-1].kids.append(html_lib.unescape(text))
            continue
        if m["tag"] is None or not m["close"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in INLINE_TAGS or not opened.get(tag):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag in INLINE_TAGS and not NAMED.search(m["attrs"]):
            continue
        if tag == "br":
            stack[-1].kids.append(" ")
            continue
        node = Node(tag, m["attrs"], known, max(stack[-1].within, stack[-1].main))
        if tag not in INLINE_TAGS:
            for i in range(len(stack) - 1, 0, -1):      # omitted end tags
                if stack[i].tag == "p" or stack[i].tag in ENDS.get(tag, ()):
                    close(i)
                elif stack[i].tag in LISTS and tag != "body":
                    break
        elif not node.skip:                              # inline: transparent
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at) if node.soft else None
            if not end or HOLDS_MAIN.search(page, at, end.start()):
                continue
            node.kids.append(html_lib.unescape(UNSEEN.sub(" ", page[at:end.start()])))
            stack[-1].kids.append(node)
            soft, at = True, end.end()
            continue
        if node.header and not node.within:              # the page's, not the article's
            if node.header == 2:
                node.drop()
            node.soft = not node.skip
        soft |= node.soft
        stack[-1].kids.append(node)
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            if tag == "title":
                continue
            if end:
                at = page.find(">", at) + 1 or len(page)
        elif tag not in VOID_TAGS and not m["attrs"].endswith("/") and tag not in INLINE_TAGS:
            stack.append(node)
            opened[tag] = opened.get(tag, 0) + 1
        elif tag in INLINE_TAGS:                         # a skipped inline element: drop to its end tag
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else at
    if soft:
        _settle(root)
    return root


# A template node: [sig, pages, text, chars, flags, kids].  text is the hash of
# its own text, or None once two pages differ.  flags: 1 skip, 2 article, 4 main.
SIG, PAGES, TEXT, CHARS, FLAGS, KIDS = range(6)


def fold(node: Node, runs: dict | None = None) -> list:
    """The template of one page: neighbouring siblings of one signature are one node.
    ``runs`` receives, per node, its folded children and the nodes of each."""
    order = [node]
    for one in order:
        order += [k for k in one.kids if isinstance(k, Node)]
    done: dict[int, list] = {}
    for one in reversed(order):
        own = " ".join("".join(k for k in one.kids if isinstance(k, str)).split())
        out = [one.sig, 1, _digest(own) if own else "", len(own), one.skip + (0, 4, 2)[one.main], []]
        members: list[list[Node]] = []
        for kid in one.kids:
            if isinstance(kid, Node):
                small = done.pop(id(kid))
                if out[KIDS] and out[KIDS][-1][SIG] == small[SIG]:
                    merge(out[KIDS][-1], small, same_page=True)
                    members[-1].append(kid)
                else:
                    out[KIDS].append(small)
                    members.append([kid])
        if runs is not None:
            runs[id(one)] = (list(out[KIDS]), members)
        done[id(one)] = out
    return done[id(node)]


def _digest(text: str) -> str:
    import hashlib
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _aligning(xs: list, ys: list):
    """Simple tree matching: the largest order-keeping match of two lists of trees, as (nodes, pairs).
    Yields the lists of children whose match it needs next."""
    if [x[SIG] for x in xs] == [y[SIG] for y in ys]:
        pairs = [(i, i) for i in range(len(xs))]
        return len(pairs), pairs
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    score = []
    for x in xs:
        score.append([])
        for y in ys:
            score[-1].append(1 + (yield x[KIDS], y[KIDS])[0] if x[SIG] == y[SIG] else 0)
    for i in range(1, len(xs) + 1):
        for j in range(1, len(ys) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + score[i - 1][j - 1])
    pairs, i, j = [], len(xs), len(ys)
    while i and j:
        if score[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + score[i - 1][j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[len(xs)][len(ys)], pairs[::-1]


def _align(xs: list, ys: list, known: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """``known`` keeps matches of lists of children that do not change meanwhile."""
    steps, found = [((id(xs), id(ys)), _aligning(xs, ys))], None
    while steps:
        try:
            wanted = steps[-1][1].send(found)
            key = id(wanted[0]), id(wanted[1])
            found = known.get(key) if known is not None else None
            if found is None:
                steps.append((key, _aligning(*wanted)))
        except StopIteration as done:
            found = done.value
            if known is not None:
                known[steps[-1][0]] = found
            steps.pop()
    return found


def merge(a: list, b: list, same_page: bool = False) -> None:
    """Merge tree ``b`` into the template ``a`` (equal signatures)."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if same_page:
            a[TEXT] = _digest(f"{a[TEXT]} {b[TEXT]}") if a[TEXT] is not None and b[TEXT] is not None else None
        else:
            a[PAGES] += b[PAGES]
            if a[TEXT] != b[TEXT]:
                a[TEXT] = None
        a[CHARS] += b[CHARS]
        a[FLAGS] |= b[FLAGS]
        kids, last = [], (0, 0)
        for i, j in [*_align(a[KIDS], b[KIDS])[1], (len(a[KIDS]), len(b[KIDS]))]:
            kids += a[KIDS][last[0]:i] + b[KIDS][last[1]:j]
            if i < len(a[KIDS]):
                todo.append((a[KIDS][i], b[KIDS][j]))
                kids.append(a[KIDS][i])
            last = (i + 1, j + 1)
        a[KIDS] = kids


def dump(tree: list) -> str:
    """JSON of the nodes in order, each with the number of its children in their place (json recurses)."""
    flat, todo = [], [tree]
    while todo:
        node = todo.pop()
        flat.append([*node[:KIDS], len(node[KIDS])])
        todo += reversed(node[KIDS])
    return json.dumps(flat)


def load(text: str) -> list:
    flat = json.loads(text)
    opened = []
    for node in flat:
        n, node[KIDS] = node[KIDS], []
        if opened:
            opened[-1][0][KIDS].append(node)
            opened[-1][1] -= 1
        opened.append([node, n])
        while opened and not opened[-1][1]:
            opened.pop()
    return flat[0]


def _chars(template: list) -> dict[int, int]:
    """Text length of every node outside boilerplate, with all below it."""
    order = [template]
    for node in order:
        if not node[FLAGS] & 1:
            order += node[KIDS]
    total: dict[int, int] = {}
    for node in reversed(order):
        total[id(node)] = 0 if node[FLAGS] & 1 else node[CHARS] + sum(total[id(k)] for k in node[KIDS])
    return total


def region(template: list) -> list[list]:
    """The nodes that hold the articles: article elements, else main elements,
    else the deepest node that holds most of the text outside boilerplate."""
    chars = _chars(template)
    for flag in (2, 4):
        found: list[list] = []
        todo = [template]
        while todo:
            node = todo.pop()
            if node[FLAGS] & 1:
                continue
            if node[FLAGS] & flag:
                found.append(node)
            else:
                todo += reversed(node[KIDS])
        if any(chars[id(n)] for n in found):
            return found
    node = template
    while True:
        total = chars[id(node)]
        heavy = [k for k in node[KIDS] if k[KIDS] and 5 * chars[id(k)] >= 3 * total > 0]
        if not heavy:
            return [node]
        node = heavy[0]


def main_text(page: str, template: list | None, distinct_pages: int, known: frozenset | None = None) -> str:
    """Blocks of the article of one page, joined by newlines."""
    root = parse(page, known)
    runs: dict[int, tuple[list, list]] = {}
    known_matches: dict[tuple[int, int], tuple] = {}
    own = fold(root, runs)
    wrapper = template if template is not None and template[SIG] == own[SIG] else own
    found = region(wrapper)
    spots = {id(n) for n in found}
    # A node that is the same on all of many different pages is template, unless
    # the whole region is the same.
    constant: set[int] = set()
    if distinct_pages >= MIN_PAGES:
        for spot in found:
            marks, varies = [], False
            todo = list(spot[KIDS])
            while todo:
                node = todo.pop()
                varies |= node[TEXT] is None
                if node[TEXT] and not node[KIDS] and node[PAGES] == template[PAGES]:
                    marks.append(id(node))
                todo += node[KIDS]
            if varies:
                constant.update(marks)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    # Nodes with the wrapper's node for them, if any, and whether they are inside; loose text; None to end a block.
    todo: list = [(root, wrapper, False)]
    while todo:
        at = todo.pop()
        if at is None:
            flush()
        elif isinstance(at, str):
            line.append(at)
        else:
            node, slot, inside = at
            if node.skip or slot is not None and id(slot) in constant:
                continue
            inside = inside or slot is not None and id(slot) in spots
            slots = _slots(slot, *runs[id(node)], known_matches)
            flush()
            todo.append(None)
            todo += [k if isinstance(k, str) else (k, slots.get(id(k)), inside)
                     for k in reversed(node.kids) if inside or not isinstance(k, str)]

    if not blocks and wrapper is not own:      # another layout than its host's: judged alone
        return main_text(page, None, 0)
    return "\n".join(blocks)


def _slots(slot: list | None, folded: list, members: list, known: dict) -> dict[int, list]:
    """Wrapper nodes of a node's children, by aligning both lists of children."""
    if slot is None or not folded:
        return {}
    return {id(kid): slot[KIDS][j] for i, j in _align(folded, slot[KIDS], known)[1] for kid in members[i]
            if folded[i][SIG] == slot[KIDS][j][SIG]}


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(
        url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _names(text: str | None, cache: dict) -> frozenset | None:
    if text is None:
        return None
    if text not in cache:
        if len(cache) > 500:
            cache.clear()
        cache[text] = frozenset(text.split())
    return cache[text]


def _partial(found):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([h for h, _, _ in found], pa.string()), pa.array([dump(t) for _, t, _ in found], pa.string()),
         pa.array([sorted(s)[:MIN_PAGES] for _, _, s in found], pa.list_(pa.string()))],
        names=["host", "template", "seen"])


def _induce(batches):
    found: dict[str, tuple[list, set]] = {}
    cache: dict[str, frozenset] = {}
    for batch in batches:
        for host, page, names in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            page = page.as_py()
            tree, digest = fold(parse(page, _names(names.as_py(), cache))), _digest(page)
            if host not in found:
                if len(found) >= FLUSH_HOSTS:
                    yield _partial([(h, *f) for h, f in found.items()])
                    found = {}
                found[host] = (tree, {digest})
            else:
                template, seen = found[host]
                merge(template, tree)
                seen.add(digest)
                if len(seen) > MIN_PAGES:     # the smallest few tell whether there are enough
                    seen.remove(max(seen))
    if found:
        yield _partial([(h, *f) for h, f in found.items()])


def _combine(table):
    import pyarrow as pa

    template, seen = None, set()
    for text, own in zip(table.column("template"), table.column("seen").to_pylist()):
        tree = load(text.as_py())
        seen.update(own)
        if template is None:
            template = tree
        else:
            merge(template, tree)
    return pa.Table.from_batches([_partial([(table.column("host")[0].as_py(), template, seen)])])


def class_names(pages: DataFrame) -> DataFrame:
    """(host, names) of hosts with MIN_PAGES pages or more: the class names that stand on two pages and on
    one in a hundred, so that their number follows from a page's names and not from the number of pages."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)\bclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""), F.lit(1))
    names = F.array_distinct(F.split(F.lower(F.translate(F.array_join(found, " "), "\"'", "  ")), r"\s+"))
    counts = (pages.select("host", F.explode(names).alias("name")).where(F.col("name") != "")
              .groupBy("host", "name").agg(F.count("*").alias("n")).where(F.col("n") >= 2))
    hosts = pages.groupBy("host").agg(F.count("*").alias("total")).where(F.col("total") >= MIN_PAGES)
    often = (counts.join(hosts, "host").where(100 * F.col("n") >= F.col("total")).groupBy("host")
             .agg(F.array_join(F.sort_array(F.collect_list("name")), " ").alias("names")))
    return (hosts.join(often.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left")
            .select("host", F.coalesce("names", F.lit("")).alias("names")))


def induce_templates(pages: DataFrame) -> DataFrame:
    """(host, template, names, n_distinct) from pages (host, html): aligned per task
    and host, then merged per host in two steps."""
    some = pages.where(F.col("html").isNotNull() & (F.col("html") != "")).select("host", "html")
    names = written(class_names(some), "names").select(F.col("host").alias("_host"), "names")
    kinds = "host string, template string, seen array<string>"
    merged = (some.join(names, F.col("host") == F.col("_host"), "left").select("host", "html", "names")
              .mapInArrow(_induce, kinds).withColumn("part", F.pmod(F.xxhash64("template"), F.lit(64)))
              .groupBy("host", "part").applyInArrow(_combine, kinds)
              .groupBy("host").applyInArrow(_combine, kinds))
    return (merged.join(names, F.col("host") == F.col("_host"), "left")
            .select("host", "template", "names", F.size("seen").alias("n_distinct")))


def extract_text(pages: DataFrame) -> DataFrame:
    """The columns page_id and url of ``pages`` with ``text`` and ``n_chars``.

    Pages of one host (of ``url``; a null or odd url has the host "") share a
    template.  Null and empty html give an empty text.  Repeated rows are
    extracted once each and repeated ids are kept; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    p = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    templates = written(induce_templates(p), "templates")
    t = templates.select(F.col("host").alias("_host"), "template", "names", "n_distinct")
    kinds = {f.name: f.dataType.simpleString() for f in p.schema}
    schema = f"page_id {kinds['page_id']}, url string, text string, n_chars long"

    def cut(batches):
        import pyarrow as pa

        loaded: dict[str, list] = {}
        cache: dict[str, frozenset] = {}
        for batch in batches:
            texts = []
            for page, template, n, names in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(),
                                                batch.column(5)):
                page, template = page.as_py(), template.as_py()
                if template is not None and template not in loaded:
                    if len(loaded) > 500:
                        loaded.clear()
                    loaded[template] = load(template)
                texts.append(main_text(page, loaded.get(template), n or 0, _names(names.as_py(), cache)) if page else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return (p.join(t, p["host"] == t["_host"], "left").select("page_id", "url", "html", "template", "n_distinct", "names")
            .mapInArrow(cut, schema))
