"""Operator 2, main text of pages by equivalence-class template deduction.

Pages of a host come from a template. A token is a tag with its place in the
page (the tags open around it), or a text block. Tokens that occur equally
often on each page of a host have the same occurrence vector; they form an
equivalence class. The vector is never built: each class is known by a sum
over pages of ``hash(page) * count``, which Spark adds up before the shuffle.
Classes must be ordered (their tokens take turns, each at the same rank on
every page; tokens that do not are taken out) and nested (two classes do not
cross, and one lies in the same gap of the other on all pages; of two that
cross, the smaller is dropped). Then tokens outside the classes are told
apart by the gap they stand in, and the classes are sought anew, until those of
the host hold no more tokens than before (at most ``ROUNDS`` times).

The gaps of the classes are the template's slots. Tag and class names label
them: the slots of the article are those in which most blocks outside the
dropped parts belong to an article element. A page with an article element
gives the blocks of that; others give the blocks in the slots of the article,
or in all slots if none lie there, without text that the template holds.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and comments are dropped in any slot.

Hosts with too few pages to deduce anything use the tags alone.

Cases: null or empty html gives empty text; a null or odd url is a host of
its own name; unclosed and misnested tags close with their parents;
repeated rows are each extracted; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_id, bound_batches, rows_to_batch, small, stored

MIN_PAGES = 4             # of a host, to call anything template
MIN_SHARE = 0.5           # of a host's pages, for template text
MOST_TOKENS = 1_000_000   # of templates that are broadcast
ROUNDS = 3                # of telling tokens apart
TAG, TEXT, DROP, ARTICLE = range(4)

# Names of HTML elements and of page parts.
BLOCKS = set("""address article aside blockquote body br button canvas caption center col colgroup dd details dialog
    dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend
    li main menu nav noscript ol optgroup option p pre section select summary table tbody td textarea tfoot th thead
    title tr ul video""".split()) - {"br"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("""head nav header footer aside form script style noscript template iframe object svg button select
    option textarea canvas menu dialog title""".split())
RAW = {"script", "style", "title", "textarea", "noscript", "iframe"}
PARTS = re.compile(r"""(?:^|[-_\s])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|header|footer|sidebar|
    aside|breadcrumbs?|cookies?|consent|notice|popup|modal|subscribe|newsletter|share|sharing|social|related|recommend\w*|
    comments?|disqus|reply|replies|form|login|signup|toolbar|pagination|pager|widget|copyright)(?:$|[-_\s])""", re.X | re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert"}
# A p closes an open p; list items, cells and options close their like.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")


def key(text: str) -> int:
    b = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(b) << 31 | zlib.crc32(b, 97) >> 1


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(text)}


def _dropped(name: str, attrs: dict[str, str]) -> bool:
    return (name in DROPPED or attrs.get("role", "").lower() in ROLES
            or "hidden" in attrs or attrs.get("aria-hidden") == "true"
            or any(PARTS.search(attrs.get(a, "")) for a in ("class", "id")))


def parse(page: str):
    """Blocks of a page in order: (number of tags before it, place, text,
    dropped, in article), and its tag tokens. ``place`` names the open tags."""
    stack: list[tuple[str, bool, bool]] = []     # (tag, dropped, article)
    blocks, tags, buf = [], [], []
    place, top_of_buf = "", ("", False, False)

    def flush():
        if buf:
            text = SPACE.sub(" ", html.unescape("".join(buf))).strip()
            buf.clear()
            if text:
                blocks.append((len(tags), place, text, top_of_buf[1], top_of_buf[2]))

    def close(i):
        nonlocal place
        del stack[i:]
        place = "/".join(s[0] for s in stack if s[0] in BLOCKS)

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.match(page, pos)
        pos = m.end()
        name = m[2]
        if name is None:
            top = stack[-1] if stack else ("", False, False)
            if m[0][:2] not in ("<!", "<?") and not (top[1] and top[0] not in BLOCKS):   # inside a dropped inline element
                if not buf:
                    top_of_buf = top
                buf.append(m[0])
            continue
        name = name.lower()
        if name == "br":
            if buf:
                buf.append(" ")
            continue
        block = name in BLOCKS
        if block:
            flush()
        if m[1]:
            tags.append(f"{place}</{name}")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
            continue
        attrs = attributes(m[3])
        if block and any(s[0] == "p" for s in stack):
            i = max(j for j, s in enumerate(stack) if s[0] == "p")
            if not any(s[0] in BLOCKS for s in stack[i + 1:]):
                close(i)
        if name in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES[name]:
                    close(i)
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select", "tbody", "thead"):
                    break
        tags.append(f"{place}<{name} {attrs.get('class', '')} {attrs.get('id', '')}")
        if name in VOID or m[3].endswith("/") and not block:
            continue
        top = stack[-1] if stack else ("", False, False)
        out = top[1] or _dropped(name, attrs)
        whole = top[2] or name in ("article", "main") or attrs.get("role") == "main" \
            or "articlebody" in attrs.get("itemprop", "").lower()
        if name in RAW:                              # raw text up to its own end tag
            end = re.compile(rf"</{name}\s*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        stack.append((name, out, whole))
        if block:
            place = "/".join(s[0] for s in stack if s[0] in BLOCKS)
    flush()
    return blocks, tags


def sequence(blocks, tags, known: dict[str, int]) -> tuple[list[int], list[int]]:
    """Token keys of a page in order, and their kinds; ``known`` keeps those of tags."""
    keys, kinds, done = [], [], 0
    if len(known) > 4096:
        known.clear()
    for t in tags:
        if t not in known:
            known[t] = key(t)
    for at, place, text, dropped, art in blocks:
        keys += [known[t] for t in tags[done:at]]
        kinds += [TAG] * (at - done)
        keys.append(key(f"{place}|{text}"))
        kinds.append(DROP if dropped else ARTICLE if art else TEXT)
        done = at
    return keys + [known[t] for t in tags[done:]], kinds + [TAG] * (len(tags) - done)


def slots(tokens: list[int], members: dict) -> list[tuple]:
    """The slots (class, gap) around each token, outermost first; around a
    class's own token, those that its class lies in."""
    around, out = (), []
    for t in tokens:
        m = members.get(t)
        if m is not None:
            c, i, size = m
            if i:
                while around and around[-1][0] != c:
                    around = around[:-1]
                around = around[:-1]
        out.append(around)
        if m is not None and i < size - 1:
            around = (*around, (c, i))
    return out


class Template:
    """Classes of a host by rounds, and the slots of its article. ``members``
    maps a token to (class, rank, size) in the last round."""

    def __init__(self, text: str | None):
        found = json.loads(text) if text else {}
        self.article = {(c, gap) for c, gap in found.get("article", ())}
        self.rounds, self.members = [], {}
        for r in range(1 + max((c["round"] for c in found.get("classes", ())), default=-1)):
            self.members = {}
            for tokens in (c["tokens"] for c in found["classes"] if c["round"] == r):
                self.members.update((t, (tokens[0], i, len(tokens))) for i, t in enumerate(tokens))
            self.rounds.append(self.members)

    def told_apart(self, tokens: list[int]) -> list[int]:
        """Tokens outside the classes, with the slot they stand in."""
        for members in self.rounds:
            tokens = [t if t in members or not a else (t ^ (a[-1][0] + a[-1][1]) * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 >> 7 & (1 << 62) - 1
                      for t, a in zip(tokens, slots(tokens, members), strict=True)]
        return tokens


def templates_of(hosts, texts):
    """The templates of rows; those of equal hosts are read once."""
    read: dict[str, Template] = {}
    for h, text in zip(hosts, texts, strict=True):
        if h not in read:
            read[h] = Template(text)
        yield read[h]


def ranks(tokens: list[int], classes: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """Lowest and highest rank of each token in the turns of its class;
    ``classes`` gives a token's class and that class's size."""
    seen, out = Counter(), {}
    for t in tokens:
        m = classes.get(t)
        if m is not None:
            rank = seen[m[0]] % m[1]
            seen[m[0]] += 1
            low, high = out.get(t, (rank, rank))
            out[t] = min(low, rank), max(high, rank)
    return out


def nesting(tokens: list[int], members: dict) -> tuple[set, set]:
    """(classes crossed by a larger one, (class, class around it, gap)) of a page."""
    crossed, around, stack = set(), set(), []
    weight = lambda m: (m[2], m[0])
    for t in tokens:
        m = members.get(t)
        if m is None or m[0] in crossed:
            continue
        c, i, size = m
        if i:
            at = next((j for j in range(len(stack) - 1, -1, -1) if stack[j][0] == c), None)
            if at is None:
                continue
            if any(weight(d) > weight(m) for d in stack[at + 1:]):
                crossed.add(c)
                del stack[at]
                continue
            crossed.update(d[0] for d in stack[at + 1:])
            del stack[at:]
        else:
            around.update((c, d[0], d[1]) for d in stack)
        if i < size - 1:
            stack.append(m)
    return crossed, around


def main_text(page: str, template: Template | None) -> str:
    """Blocks in the slots of the article, without dropped parts."""
    blocks, tags = parse(page)
    kept = [n for n, b in enumerate(blocks) if not b[3]]
    if any(blocks[n][4] for n in kept):
        kept = [n for n in kept if blocks[n][4]]
    elif template and template.members:
        tokens, kinds = sequence(blocks, tags, {})
        tokens = template.told_apart(tokens)
        around = slots(tokens, template.members)
        at = [i for i, kind in enumerate(kinds) if kind != TAG]
        kept = [n for n in kept if tokens[at[n]] not in template.members]
        kept = [n for n in kept if not template.article.isdisjoint(around[at[n]])] or kept
    return "\n".join(blocks[n][2] for n in kept)


def host(url: str = "url"):
    """Host of a url, lower case; the url itself where it has none."""
    u = F.coalesce(F.col(url), F.lit(""))
    return F.lower(F.regexp_replace(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://|[/?#].*$", ""))


def tokenised(pages: DataFrame) -> DataFrame:
    """(host, mark, tokens, kinds) of pages (host, page_id, html): each page's
    number in the occurrence vectors, its token keys and kinds as bytes."""
    fields = pa.schema([("host", pa.string()), ("mark", pa.int64()), ("tokens", pa.binary()), ("kinds", pa.binary())])

    def run(batches):
        known: dict[str, int] = {}
        for b in batches:
            rows = []
            for h, pid, page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                tokens, kinds = sequence(*parse(page), known)
                mark = key(f"{pid}|{zlib.crc32(page.encode('utf-8', 'surrogatepass'))}") & 0xFFFFFFFF
                rows.append((h, mark, np.array(tokens, np.int64).tobytes(), bytes(kinds)))
            yield rows_to_batch(rows, fields)

    return pages.select("host", "page_id", "html").mapInArrow(run, "host string, mark bigint, tokens binary, kinds binary")


def with_template(rows: DataFrame, classes: DataFrame | None, article: DataFrame | None = None) -> DataFrame:
    """``rows`` with the template of their host as text, null without one.
    A template holds at most twice the tokens of a mean page of its host."""
    if classes is None:
        return rows.withColumn("template", F.lit(None).cast("string"))
    found = classes.groupBy("host").agg(F.collect_list(F.struct("round", "tokens")).alias("classes"))
    if article is not None:
        found = found.join(article.groupBy("host").agg(F.collect_list(F.array("class", "gap")).alias("article")), "host", "left")
    found = found.select("host", F.to_json(F.struct(*found.columns[1:])).alias("template"))
    few = (classes.agg(F.sum(F.size("tokens"))).first()[0] or 0) <= MOST_TOKENS
    return rows.join(F.broadcast(found) if few else found, "host", "left")


def gathered(rows: DataFrame, each, kind: str) -> DataFrame:
    """Rows that ``each`` makes of a batch of (host, template, *columns)."""
    fields = pa.schema([(f.split()[0], pa.string() if f.split()[1] == "string" else pa.int64()) for f in kind.split(", ")])

    def run(batches):
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            made = each(zip(columns[0], templates_of(columns[0], columns[1]), *columns[2:], strict=True))
            yield rows_to_batch(made, fields)

    return rows.mapInArrow(run, kind)


def frequent(tokens: DataFrame, classes: DataFrame | None, sizes: DataFrame) -> DataFrame:
    """(host, token, vector, pages, n) of the tokens on enough pages of their
    host; those outside the present ``classes`` are told apart by their slots.

    Partial sums run before the shuffle, so a host with a third of all pages
    reaches its task as one row a token and map task.
    """
    def each(pages):
        sums: dict[tuple[str, int], list[int]] = {}
        for h, template, mark, page in pages:
            for t, n in Counter(template.told_apart(np.frombuffer(page, np.int64).tolist())).items():
                s = sums.setdefault((h, t), [0, 0, 0])
                s[0] = (s[0] + mark * n) & 0x7FFFFFFFFFF
                s[1] += 1
                s[2] += n
        return [(h, t, *s) for (h, t), s in sums.items()]

    found = (gathered(with_template(tokens, classes).select("host", "template", "mark", "tokens"), each,
                      "host string, token bigint, vector bigint, pages bigint, n bigint")
             .groupBy("host", "token").agg(F.sum("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("n").alias("n")))
    return (found.join(small(sizes), "host").where(F.col("pages") >= MIN_SHARE * F.col("all_pages"))
            .select("host", "token", F.pmod("vector", F.lit(1 << 43)).alias("vector"), "pages", "n"))


def candidates(found: DataFrame) -> DataFrame:
    """(host, class, size, token) of the equivalence classes of frequent tokens:
    at most twice as many of a host as a mean page has."""
    return (found.repartition("host").groupBy("host", "vector", "pages", "n")
            .agg(F.collect_list("token").alias("tokens")).where(F.size("tokens") > 1)
            .select("host", F.array_min("tokens").alias("class"), F.size("tokens").alias("size"), F.explode("tokens").alias("token")))


def only(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """(host, mark, tokens): pages with their frequent tokens alone. Others can
    be in no class, told apart or not, since a slot's token has no more pages."""
    def each(pages):
        read, rows = {}, []
        for h, listed, mark, page in pages:
            if h not in read:
                read[h] = set(json.loads(listed))
            rows.append((h, mark, np.array([t for t in np.frombuffer(page, np.int64).tolist() if t in read[h]], np.int64).tobytes()))
        return rows

    lists = found.groupBy("host").agg(F.to_json(F.collect_list("token")).alias("listed"))
    rows = tokens.join(F.broadcast(lists) if found.count() <= MOST_TOKENS else lists, "host").select("host", "listed", "mark", "tokens")
    fields = pa.schema([("host", pa.string()), ("mark", pa.int64()), ("tokens", pa.binary())])

    def run(batches):
        for b in batches:
            yield rows_to_batch(each(zip(*(c.to_pylist() for c in b.columns), strict=True)), fields)

    return rows.mapInArrow(run, "host string, mark bigint, tokens binary")


def with_candidates(tokens: DataFrame, classes: DataFrame | None, tried: DataFrame) -> DataFrame:
    """(host, template, tokens, tried): pages of hosts with candidate classes,
    given as text (rows of lists of ``tried``'s other columns)."""
    tried = stored(tried)
    lists = tried.groupBy("host").agg(F.to_json(F.collect_list(F.array([F.col(c).cast("bigint") for c in tried.columns[1:]]))).alias("tried"))
    few = tried.count() <= MOST_TOKENS
    return with_template(tokens, classes).join(F.broadcast(lists) if few else lists, "host").select("host", "template", "tried", "tokens")


def ordered(tokens: DataFrame, classes: DataFrame | None, tried: DataFrame) -> DataFrame:
    """(host, class, tokens): candidates in order, of the tokens that keep
    their rank on every page."""
    def each(pages):
        found, read = {}, {}
        for h, template, listed, page in pages:
            if h not in read:
                read[h] = {t: (c, size) for c, size, t in json.loads(listed)}
            for t, (low, high) in ranks(template.told_apart(np.frombuffer(page, np.int64).tolist()), read[h]).items():
                before = found.get((h, t))
                found[h, t] = (read[h][t][0], low, high) if before is None else (before[0], min(before[1], low), max(before[2], high))
        return [(h, t, *v) for (h, t), v in found.items()]

    return (gathered(with_candidates(tokens, classes, tried), each, "host string, token bigint, class bigint, low bigint, high bigint")
            .groupBy("host", "class", "token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low = high")
            .repartition("host").groupBy("host", "class").agg(F.array_sort(F.collect_list(F.struct("low", "token"))).alias("found"))
            .where(F.size("found") > 1).select("host", F.col("found.token").alias("tokens")))


def nested(tokens: DataFrame, classes: DataFrame | None, tried: DataFrame) -> DataFrame:
    """(host, tokens): the ordered classes ``tried`` that nest on every page."""
    tried = stored(tried)
    flat = tried.select("host", F.col("tokens")[0].alias("class"), F.size("tokens").alias("size"), F.posexplode("tokens").alias("rank", "token"))

    def each(pages):
        found, read = {}, {}
        for h, template, listed, page in pages:
            if h not in read:
                read[h] = {t: (c, i, size) for c, size, i, t in json.loads(listed)}
            crossed, around = nesting(template.told_apart(np.frombuffer(page, np.int64).tolist()), read[h])
            for c in crossed:
                found[h, c, c] = 0, 1
            for c, outer, gap in around:
                low, high = found.get((h, c, outer), (gap, gap))
                found[h, c, outer] = min(low, gap), max(high, gap)
        return [(*at, *v) for at, v in found.items()]

    wrong = (gathered(with_candidates(tokens, classes, flat), each, "host string, class bigint, outer bigint, low bigint, high bigint")
             .groupBy("host", "class", "outer").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
             .select("host", "class"))
    return tried.withColumn("class", F.col("tokens")[0]).join(small(stored(wrong)), ["host", "class"], "left_anti").select("host", "tokens")


def templates(pages: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(host, round, tokens) of the valid classes, their tokens in order, and
    (host, class, gap) of the slots of the article; None if there are none."""
    tokens, classes = stored(tokenised(pages)), None
    sizes = stored(tokens.groupBy("host").agg(F.count("*").alias("all_pages")).where(F.col("all_pages") >= MIN_PAGES))
    found = stored(frequent(tokens, None, sizes))
    held, open_ = None, stored(only(tokens, found))       # pages of hosts whose classes still grow
    for r in range(ROUNDS):
        if r:
            found = frequent(open_, classes, sizes)
        valid = nested(open_, classes, ordered(open_, classes, candidates(found)))
        valid = stored(valid.select("host", F.lit(r).alias("round"), "tokens"))
        now = valid.groupBy("host").agg(F.sum(F.size("tokens")).alias("now"))
        if held is not None:
            now = now.join(small(held), "host").where("now > before").select("host", "now")
        now = stored(now)
        if now.isEmpty():
            break
        valid = valid.join(small(now), "host", "left_semi")
        classes = valid if classes is None else classes.unionByName(valid)
        open_, held = open_.join(small(now), "host", "left_semi"), now.select("host", F.col("now").alias("before"))
    if classes is None:
        return None, None

    def each(rows):
        sums = {}
        for h, template, page, kinds in rows:
            if TEXT not in kinds and ARTICLE not in kinds:
                continue
            told = template.told_apart(np.frombuffer(page, np.int64).tolist())
            for t, kind, around in zip(told, kinds, slots(told, template.members), strict=True):
                if kind in (TEXT, ARTICLE) and t not in template.members:
                    for c, gap in around:
                        s = sums.setdefault((h, c, gap), [0, 0])
                        s[kind == ARTICLE] += 1
        return [(*at, *s) for at, s in sums.items()]

    article = (gathered(with_template(tokens, classes).select("host", "template", "tokens", "kinds"), each,
                        "host string, class bigint, gap bigint, other bigint, own bigint")
               .groupBy("host", "class", "gap").agg(F.sum("other").alias("other"), F.sum("own").alias("own"))
               .where("own > other").select("host", "class", "gap"))
    return classes, article


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    bound_batches(pages.sparkSession)
    kind, atype = arrow_id(pages, "page_id")
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host"))
    joined = with_template(own, *templates(own.select("host", "page_id", "html")))
    fields = pa.schema([("page_id", atype), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            hosts, texts, *rest = (c.to_pylist() for c in b.columns)
            rows = []
            for template, pid, url, page in zip(templates_of(hosts, texts), *rest, strict=True):
                text = main_text(page, template)
                rows.append((pid, url, text, len(text)))
            yield rows_to_batch(rows, fields)

    return joined.select("host", "template", "page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint")
