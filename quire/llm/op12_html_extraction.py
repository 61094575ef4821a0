"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from templates. A page is a list of tokens: tags (with
their class and id) and the blocks of text between them.

1. *Occurrence vectors.* The pages of a host are dealt into cohorts of about
   ``COHORT`` pages (a hot host has many cohorts; each is one task's group).
   Copies count once. A token's vector is the number of its occurrences in each
   page of the cohort.
2. *Equivalence classes.* Tokens with equal vectors form a class. A class may
   belong to the template if it occurs in at least half of the pages, and if its
   tokens come in the same order, round by round, in all of them; tokens that
   break the order are taken out. A text block only joins such a class if it
   stands in every page of the class, once, and not in the article's own tag.
3. *Nesting.* Classes are nested: the widest one, whose tokens stand once in
   most pages, is the skeleton, and another one is kept if all its tokens lie in
   one and the same gap of the skeleton in every page.
4. *Slots.* What the nested classes do not hold lies in slots between template
   tokens. A slot's place in the skeleton says which open tags enclose it. Slots
   within menus, headers, footers, sidebars, notices, adverts, forms, comments
   of readers and the like hold no main text, whatever is in them; nor does a
   template's own text. If the template has an article (or main) tag, only slots
   within it are taken; else all others but blocks that only have links.

The rest of a page is walked with the same rules, so that an advert inside a
slot goes too; blocks end at block-level tags, character references are decoded,
white space becomes one space. A cohort of one page deduces nothing and its page
is walked by these rules alone.

Nulls and edge cases: null or empty html gives the empty text. Pages without a
host form cohorts of their own (as a host named by the empty string). Unclosed
and truncated tags end with the page; a truncated tag is no text. Unclosed
scripts, styles and comments reach to the end. Rows with null or repeated ids
are pages of their own. Very long pages are held whole, one at a time beside the
vectors of their cohort's tokens. An empty table gives an empty result. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, column, row_slices, scratch, shuffle_partitions, table, text_slices

#: Pages and bytes of html of a cohort, about.
COHORT, COHORT_BYTES = 64, 4 << 20

# Names of HTML.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select", "object")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
           "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
           "wbr", "img"}
_ASIDE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "label", "input", "head"}
_MAIN = ("article", "main")
_FRAME = {"html", "body", "article", "main"}
#: Words of a class or id that mark what is beside the text.
_MARKS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|gdpr|popup|modal|newsletter|subscribe|nav|navbar|"
    r"navigation|menu|breadcrumbs?|header|footer|sidebar|aside|widget|related|recommend\w*|comments?|replies|respond|share|sharing|social|"
    r"login|signup|search|pagination|pager|masthead|toolbar|skip)(?:$|[^a-z])")
_ROLES = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|dialog|alert|form|menu|menubar)$")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[a-zA-Z/][^>]*(?:>|\Z)",
                    re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_END_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}


def tokens(page: str) -> list[tuple[str, str, str]]:
    """``(kind, name, more)``: an opening tag with its marks, a closing tag,
    or a text as it stands. Raw elements (scripts, titles, ...) are left out
    with their content, as are comments."""
    out, at = [], 0
    while True:
        m = _TOKEN.search(page, at)
        if not m:
            if at < len(page):
                out.append(("text", "", page[at:]))
            return out
        if m.start() > at:
            out.append(("text", "", page[at:m.start()]))
        at, name = m.end(), (m.group(2) or "").lower()
        if not name:
            continue
        if m.group(1):
            out.append(("close", name, ""))
        elif name in _END_RAW:
            end = _END_RAW[name].search(page, at)
            at = page.find(">", end.end()) + 1 if end else len(page)
            at = at or len(page)
            out.append(("raw", name, ""))
        else:
            marks = " ".join(f"{a.lower()}={(x or y or z).lower()}" for a, x, y, z in _ATTRIBUTE.findall(m.group(3)))
            out.append(("open", name, marks))


def beside(name: str, marks: str, main: bool) -> bool:
    """Whether an element holds what is beside the main text. An article may
    have a header of its own, and a page's frame may have any class."""
    if name in _FRAME or main and name == "header":
        return False
    if name in _ASIDE:
        return True
    role = False
    for part in marks.split():
        role = part.startswith("role=") or role and "=" not in part
        value = part.partition("=")[2] or part
        if main:
            value = value.replace("header", "")
        if _ROLES.match(value) if role else _MARKS.search(value):
            return True
    return False


# ---------------------------------------------------------------- deduction

class Page:
    """A page's tokens; ``keys`` are what vectors count: tags, and blocks of
    text by their digest. For each token: whether an element beside the main
    text, an article, a link is open."""

    def __init__(self, page: str):
        self.tokens = tokens(page)
        self.has_main = any(k == "open" and n in _MAIN for k, n, _ in self.tokens)
        self.aside, self.in_main, self.in_link, self.keys = [], [], [], []
        stack: list[tuple[str, bool, bool]] = []       # name, beside, main
        for kind, name, more in self.tokens:
            if kind == "open":
                main = name in _MAIN or bool(stack and stack[-1][2])
                side = bool(stack and stack[-1][1]) or (beside(name, more, main))
                if name not in _VOID:
                    _close_implied(stack, name)
                    stack.append((name, side, main))
                key = (name, more)
            elif kind == "close":
                key = ("/" + name, "")
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                    if stack[k][0] in _MAIN or stack[k][0] in ("body", "table"):
                        if name in _INLINE or name == "p":
                            break
            elif kind == "raw":
                key = ("raw", name)
            else:
                key = ("", zlib.crc32(" ".join(more.split()).encode("utf-8", "replace")))
            self.keys.append(key)
            self.aside.append(bool(stack) and stack[-1][1])
            self.in_main.append(bool(stack) and stack[-1][2])
            self.in_link.append(any(s[0] == "a" for s in stack[-4:]))


def _close_implied(stack: list[tuple[str, bool, bool]], name: str) -> None:
    """A paragraph or list item ends where a new block of its kind begins."""
    if name in _INLINE or not stack:
        return
    for k in range(len(stack) - 1, -1, -1):
        open_name = stack[k][0]
        if open_name == "p" or (open_name == name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
            del stack[k:]
            return
        if open_name not in _INLINE:
            return


def template(pages: list[Page]) -> set:
    """Keys of the nested template classes of a cohort's distinct pages."""
    seen: dict[tuple, Page] = {}
    for p in pages:
        seen.setdefault(tuple(p.keys), p)
    distinct = list(seen.values())
    if len(distinct) < 2:
        return set()
    vectors: defaultdict[tuple, dict[int, int]] = defaultdict(dict)
    for no, p in enumerate(distinct):
        for key, n in Counter(p.keys).items():
            vectors[key][no] = n
    # text inside an article is never a template's
    own = {k for p in distinct for k, m, s in zip(p.keys, p.in_main, p.aside) if m and not s and k[0] == ""}
    classes: defaultdict[tuple, list] = defaultdict(list)
    for key, of in vectors.items():
        if 2 * len(of) >= len(distinct) and (key[0] != "" or (key not in own and set(of.values()) == {1} and len(of) >= 3)):
            classes[tuple(sorted(of.items()))].append(key)
    valid = []
    for vector, keys in classes.items():
        kept = _ordered(keys, [(distinct[no], n) for no, n in vector])
        if kept:
            valid.append((len(vector), set(dict(vector).values()) == {1}, kept, dict(vector)))
    valid.sort(key=lambda c: (-c[1], -c[0], -len(c[2])))
    if not valid:
        return set()
    skeleton = set(valid[0][2])
    out = set(skeleton)
    for _, _, kept, vector in valid[1:]:
        if _nested(kept, skeleton, [distinct[no] for no in vector]):
            out.update(kept)
    return out


def _ordered(keys: list, pages: list[tuple[Page, int]]) -> list:
    """The keys of a class that come in one order, once a round, in all its
    pages; a key that breaks it is taken out."""
    members, want, bad = set(keys), None, set()
    for page, rounds in pages:
        row = [k for k in page.keys if k in members]
        size = len(members)
        for at in range(0, size * rounds, size):
            part = row[at:at + size]
            if want is None:
                want = list(dict.fromkeys(part))
            rank = {k: i for i, k in enumerate(want)}
            last = -1
            for k in part:
                if rank.get(k, -1) <= last:
                    bad.add(k)
                else:
                    last = rank[k]
    return [k for k in (want or []) if k not in bad]


def _nested(kept: list, skeleton: set, pages: list[Page]) -> bool:
    """Whether a class lies in one and the same gap of the skeleton."""
    members, place = set(kept), set()
    for page in pages:
        gap = 0
        for k in page.keys:
            if k in skeleton:
                gap += 1
            elif k in members:
                place.add(gap)
        if len(place) > 1:
            return False
    return True


def main_text(page: Page, deduced: set, main_slots: bool) -> str:
    """Texts of the slots that hold main text, block by block. Outside an
    article, a block that only has links is a menu."""
    blocks, part, linked = [], [], True
    for (kind, name, more), key, side, main, link in zip(page.tokens, page.keys, page.aside, page.in_main, page.in_link):
        if kind == "text":
            if not side and (main or not main_slots) and key not in deduced:
                part.append(more)
                linked = linked and link and not main or not more.strip() and linked
        elif name not in _INLINE:
            blocks.append([] if linked else part)
            part, linked = [], True
    blocks.append([] if linked else part)
    done = (" ".join(references.unescape("".join(b)).split()) for b in blocks if b)
    return " ".join(b for b in done if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``host, cohort, page_id, url, packed`` sorted by the first two."""
    unpack, held, key = zstandard.ZstdDecompressor(), [], None

    def flush():
        pages = [Page(unpack.decompress(p).decode("utf-8", "replace") if p else "") for _, _, p in held]
        deduced = template(pages)
        # the cohort's template has an article if most of its pages do
        has = 2 * sum(p.has_main for p in pages) >= len(pages)
        texts = [main_text(p, deduced, p.has_main or (has and ("/article", "") in p.keys)) for p in pages]
        out = pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in held], kind), pa.array([h[1] for h in held], pa.string()), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
        held.clear()
        return out
    for batch in row_slices(batches, 64):
        kind = batch.column(2).type
        hosts, cohorts, ids, urls, packed = (batch.column(i).to_pylist() for i in range(5))
        for h, c, i, u, p in zip(hosts, cohorts, ids, urls, packed):
            if (h, c) != key and held:
                yield flush()
            key = (h, c)
            held.append((i, u, p))
    if held:
        yield flush()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in text_slices(batches, 2):
        packed = [press.compress(h) if h else None for h in batch.column(2).to_pylist()]
        size = [len(h) if h else 0 for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(size, pa.int64()),
                                          batch.column(3)], names=["page_id", "url", "packed", "size", "host"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 cohort: int = COHORT, cohort_bytes: int = COHORT_BYTES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    url = column(url_col).cast("string")
    host = F.lower(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"://([^/?#]*)", 1)).otherwise(F.lit("")))
    src = pages.select(column(id_col).alias("page_id"), url.alias("url"), column(html_col).cast("binary").alias("html"),
                       F.coalesce(host, F.lit("")).alias("host"))
    kind = src.schema["page_id"].dataType.simpleString()
    sizes = src.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).alias("bytes"))
    cohorts = scratch(sizes.select("host", F.greatest(F.ceil(F.col("n") / cohort), F.ceil(F.col("bytes") / cohort_bytes), F.lit(1))
                                   .cast("bigint").alias("cohorts")))
    packed = src.mapInArrow(_pack, f"page_id {kind}, url string, packed binary, size long, host string")
    n = shuffle_partitions(pages.sparkSession)
    rows = (packed.join(broadcast_if_small(cohorts), "host")
            .withColumn("cohort", F.pmod(F.xxhash64("page_id", "url", "size"), F.col("cohorts")))
            .select("host", "cohort", "page_id", "url", "packed"))
    return (rows.repartition(n, "host", "cohort").sortWithinPartitions("host", "cohort", "page_id", "url", "packed")
            .mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
