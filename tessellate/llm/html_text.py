"""Main text of web pages by consensus paths of each host."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Comments, elements whose content is no markup, and tags. Quantifiers don't give back, so broken markup costs no time.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-z:-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|\b(hidden)\b", re.I)

# Elements and name parts of the HTML standard and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr
math mrow mi mo mn ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mspace
mpadded mphantom menclose semantics""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED_TAGS = frozenset("nav footer aside button select dialog menu head title audio video canvas annotation".split())
SKIPPED_NAMES = frozenset("""nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement
sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay comment comments
commentlist disqus respond reply replies share sharing social related recommended recommendations breadcrumb breadcrumbs
newsletter subscribe subscription login signup search pagination pager widget toolbar tags skip""".split())
# Of these, names that a page's frame may have as well; they skip what does not hold the article.
LAYOUT_NAMES = frozenset("nav navbar navigation menu header masthead footer sidebar aside banner modal overlay search widget toolbar".split())
# A name that says what a layout has, or what a page is laid out around, tells nothing about the element's own text.
QUALIFIERS = frozenset("has no with without hide show is js".split())
OWNERS = frozenset("entry post article page section story content".split())  # of a header that is part of the text
TOPICS = frozenset("work works literature research".split())  # "related" to these is a chapter
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CLOSES = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
          "option": frozenset(["option"])}
HOLDERS = {"li": frozenset(["ul", "ol"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]),
           "td": frozenset(["table"]), "th": frozenset(["table"])}


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        if m[5]:
            out.setdefault("hidden", "")
        else:
            out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _names(value: str) -> list[list[str]]:
    """Parts of each class and id, split at case changes too."""
    return [p for word in value.split() if (p := [x for x in re.split(
        r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", word).lower()) if x])]


def _skipping_name(parts: list[str]) -> int:
    if parts[0] in QUALIFIERS:
        return 0
    skip = 0
    for i, part in enumerate(parts):
        if part not in SKIPPED_NAMES or part == "header" and i and parts[i - 1] in OWNERS:
            continue
        if part == "related" and i + 1 < len(parts) and parts[i + 1] in TOPICS:
            continue
        if part not in LAYOUT_NAMES:
            return HARD
        skip = SOFT
    return skip


HARD, SOFT = 1, 2  # skipped for sure; skipped unless the article is inside


def _skipped(tag: str, attrs: dict[str, str]) -> int:
    if tag in SKIPPED_TAGS:
        return HARD
    if attrs:
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(
                r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
            return HARD
        if attrs.get("role", "").lower() in SKIPPED_ROLES:
            return SOFT
        if tag in ("html", "body", "main", "article"):
            return 0
        skips = set(map(_skipping_name, _names(f"{attrs.get('class', '')} {attrs.get('id', '')}")))
        if HARD in skips or SOFT in skips:
            return HARD if HARD in skips else SOFT
    return SOFT if tag == "form" else 0


def element(tag: str, source: str, memo: dict) -> tuple[str, int]:
    """Path step and whether the element is skipped (HARD, SOFT or not). A step is the tag with its
    classes, whose numbers count as the same. ``memo`` holds what was seen."""
    if (known := memo.get((tag, source))) is None:
        attrs = _attributes(source) if source else {}
        names = sorted(set(re.sub(r"\d+", "#", attrs.get("class", "").lower()).split()))
        known = (".".join([tag, *names]), _skipped(tag, attrs))
        if len(source) < 200:
            if len(memo) > 50_000:
                memo.clear()
            memo[tag, source] = known
    return known


def blocks(page: str, memo: dict | None = None) -> list[tuple[tuple[str, ...], str, int, bool]]:
    """Blocks of text outside skipped elements, in page order: the generalised path of
    the block elements around it, text, characters within links, heading or not.

    Names of a page's frame, roles and forms only tell at first sight: such an
    element is not skipped if it holds the main element, nor if it is a form or
    holds an article, and most of the page's prose is inside.
    """
    memo = {} if memo is None else memo
    out: list = []
    stack: list[tuple[str, str, int, int]] = []  # of open elements: tag, step (empty: inline), hard, number if soft
    path: tuple[str, ...] = ()
    parts: list[str] = []
    skipped = articles = headings = links = linked = 0  # open ones of each kind; characters within links
    soft: tuple[int, ...] = ()  # numbers of the open soft ones
    numbers = 0  # of soft ones so far
    cleared: set[int] = set()  # those that hold the main element
    holding: set[int] = set()  # those that may hold the article

    def close(height: int):
        """Take the elements above a height off the stack."""
        nonlocal path, skipped, articles, headings, links, soft
        while len(stack) > height:
            tag, step, hard, number = stack.pop()
            skipped -= hard
            if number:
                soft = tuple(n for n in soft if n != number)
            if step:
                path = path[:-1]
                articles -= tag == "article"
                headings -= tag in HEADINGS
            elif tag == "a":
                links -= 1

    def enter(tag: str, step: str, skip: int):
        nonlocal skipped, soft, numbers
        number = 0
        if skip == SOFT:
            numbers += 1
            number = numbers
            soft = (*soft, number)
        stack.append((tag, step, int(skip == HARD), number))
        skipped += skip == HARD

    at = 0
    for m in MARKUP.finditer(page):
        begin = m.start()
        if begin > at and not skipped:
            text = page[at:begin]
            parts.append(text)
            if links:
                linked += len(text.strip())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
                continue
            skip = 0 if m["end"] else element(tag, m["attrs"], memo)[1]
            if skip == SOFT or m["end"] and soft:
                # text before and after such an element is not of one kind
                _add_piece(out, path, parts, soft)
            if m["end"]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][1]:
                        break  # an inline end tag closes nothing beyond its block
                    if stack[i][0] == tag:
                        _, _, hard, number = stack.pop(i)
                        skipped -= hard
                        if number:
                            soft = tuple(n for n in soft if n != number)
                        links -= tag == "a"
                        break
            elif tag not in VOID and not m["attrs"].endswith("/"):
                enter(tag, "", skip)
                links += tag == "a"
            continue
        if parts:
            _add_piece(out, path, parts, soft)
        _end_block(out, linked, headings > 0)
        linked = 0
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in VOID:
            continue
        # elements whose end tag may be left out end here
        over, holders = CLOSES.get(tag, CLOSES["p"]), HOLDERS.get(tag, frozenset())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in over:
                close(i)
                if tag != "tr":
                    break
            elif stack[i][0] in holders or stack[i][1] and tag not in HOLDERS:
                break
        if not m["attrs"].endswith("/"):
            step, skip = element(tag, m["attrs"], memo)
            if tag == "header" and not articles:
                skip = skip or SOFT
            enter(tag, step, skip)
            path = (*path, step)
            if soft and not skipped and tag in ("article", "main", "form"):
                (cleared if tag == "main" else holding).update(soft)
            articles += tag == "article"
            headings += tag in HEADINGS
    if at < len(page) and not skipped:
        parts.append(page[at:])
    if parts:
        _add_piece(out, path, parts, soft)
    _end_block(out, linked, headings > 0)
    return _unskipped(out, sorted(holding - cleared), cleared)


def _add_piece(out: list, path: tuple[str, ...], parts: list[str], soft: tuple[int, ...]) -> None:
    """Text of one kind within the block that is open; pieces wait at the end of ``out``."""
    if parts:
        out.append((path, "".join(parts), soft, None))
        parts.clear()


def _end_block(out: list, linked: int, heading: bool) -> None:
    """The pieces that wait become a block."""
    begin = len(out)
    while begin and out[begin - 1][3] is None:
        begin -= 1
    if begin < len(out):
        pieces = out[begin:]
        del out[begin:]
        out.append((pieces[0][0], [(x[1], x[2]) for x in pieces], linked, heading))


def _unskipped(out: list, holding: list[int], cleared: set[int]):
    """Blocks of the pieces that no soft element skips; of ``holding``, from the outermost,
    those go free that have most of the prose which the others leave."""
    for number in holding:
        inside = total = 0
        for _, pieces, _, heading in out:
            for text, soft in pieces:
                # what is in further ones of them may yet turn out to be the article
                if all(n in cleared or n == number or n in holding and number in soft for n in soft):
                    w = max(weight(" ".join(text.split()) or " ", 0, heading), 0)
                    total += w
                    inside += w * (number in soft)
        if 2 * inside > total:
            cleared.add(number)
    found = []
    for path, pieces, linked, heading in out:
        text = "".join([t for t, soft in pieces if not soft or cleared.issuperset(soft)])
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            found.append((path, text, min(linked, len(text)), heading))
    return found


def weight(text: str, linked: int, heading: bool) -> int:
    """Prose and headings speak for a container, text made of links against it,
    scraps of a few words are neutral."""
    if 2 * linked > len(text):
        return -len(text)
    return len(text) if heading or len(text) >= 40 or text[-1] in ".!?" else 0


def scores(found) -> dict[tuple[str, ...], int]:
    """The weight of all blocks below each container path."""
    out: dict[tuple[str, ...], int] = {}
    for path, text, linked, heading in found:
        w = weight(text, linked, heading)
        for i in range(1, len(path)):  # the block's own element is no container
            out[path[:i]] = out.get(path[:i], 0) + w
    return out


def best(found) -> tuple[str, ...]:
    """The container path with the highest score, the deepest of equals."""
    return max(((s, len(p), p) for p, s in scores(found).items()), default=(0, 0, ()))[2]


def text_below(found, path: tuple[str, ...]) -> str:
    return "\n".join(t for p, t, _, _ in found if p[:len(path)] == path)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``.

    Each page scores its containers and votes for the generalised tag-class
    path of the best; the votes are added up by host in Spark, and every page
    is extracted again with its host's winning path (of equals the deepest,
    then the last by name). A page where that path has no text uses
    its own best container. The text is that of the blocks below the path
    without menus, headers, footers, sidebars, notices, adverts, forms,
    reader comments, scripts and styles, which elements' tags, classes, ids or
    roles tell (but an element that holds the article is none of these);
    white space within a block is one space.

    Null and empty pages have an empty text; pages without a url or with one
    that names no host vote as one host; repeated rows give repeated rows, an
    empty table none; other columns are not read. A host's pages are spread
    over tasks by the skew join; its votes are summed before the shuffle.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    hosted = pages.withColumn("host", host)

    def vote(batches):
        for batch in batches:
            votes, memo = {}, {}
            for where, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path := best(blocks(page, memo)):
                    key = (where, ">".join(path))
                    votes[key] = votes.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict({"host": pa.array([k[0] for k in votes], pa.string()),
                                              "path": pa.array([k[1] for k in votes], pa.string()),
                                              "votes": pa.array(list(votes.values()), pa.int64())})

    votes = hosted.select("host", "html").mapInArrow(vote, "host string, path string, votes long")
    # stored, so that the join below shuffles both sides itself and can split a host's pages
    winners = stored(votes.groupBy("host", "path").agg(F.sum("votes").alias("votes")).groupBy(
        F.col("host").alias("of_host")).agg(F.max_by("path", F.struct("votes", F.size(F.split("path", ">")), "path")).alias("path")),
        "host-paths")

    def again(batches):
        for batch in batches:
            texts, memo = [], {}
            for path, page in zip(batch.column("path").to_pylist(), batch.column("html").to_pylist()):
                found = blocks(page, memo)
                texts.append((text_below(found, tuple(path.split(">"))) if path else "") or text_below(found, best(found)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return (hosted.join(winners, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "path")
            .mapInArrow(again, "page_id long, url string, text string, n_chars long"))
