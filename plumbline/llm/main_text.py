"""Main text of web pages by text-to-tag ratios (operator 13).

The standard library's parser streams a page's events into lines: the text between two borders of blocks, with the
number of tags in it, the characters inside links, and the elements it lies in. A line's ratio is its characters outside
links over its tags (one at least); a line inside an element that never holds the article (menus, headers, footers,
asides, forms, scripts, styles, and what roles, classes, ids or hidden styles name as such, adverts, notices and
readers' comments among them) has ratio 0. Ratios are smoothed by a Gaussian over neighbouring lines and clustered into
high and low by a threshold; the lines of high ratio say where the content region is: the smallest element that holds
nearly all of their weight, an article as a whole. Of the region, every line that is not excluded belongs to the text,
short ones too, but for lists whose lines are all links; headings right before it belong to it as well.

Text: character references are decoded, a run of white space (as ``str.split`` takes it, no-break spaces and ``<br>``
included) becomes one space, lines are trimmed and joined by an empty line.

Rows: a null or empty page, and one without a line of text that is not excluded, gives an empty text; every row gives
one row, repeated ones too; broken markup (unclosed or stray tags, declarations, references) is read as far as it goes,
and if an unclosed element excludes everything, articles in it count. Long pages are read whole; a worker holds one
block of pages (4 MB, or one longer page) and its lines. An empty table gives no rows. All columns of the page are kept;
a column named ``text`` or ``n_chars`` is replaced.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import pieces_of, table

SPREAD = 2.0  # deviation of the Gaussian, in lines
NEARLY = 0.7  # of the weight of the lines of high ratio
LINKED = 0.8  # share of a line's characters in links from which it is a link

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul xmp".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LISTS = {"ul", "ol", "dl", "menu", "dir"}
PARTS = {"ul", "ol", "dl", "tr", "tbody"}  # regions that do not hold an article
REGIONS = LISTS | set("article blockquote body center dd details div figure main section table tbody td tr".split())
ARTICLES = {"article", "main"}
#: Start tags that end an open element of the named kinds, as far as the border.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
BORDERS = {"article", "main", "body", "td", "th"}  # that the end tag of another element does not leave
HOLD_P = BORDERS | {"table", "div", "section", "blockquote", "li"}  # in which a paragraph starts anew
NEVER = set(
    "applet aside audio button canvas datalist dialog embed footer head iframe input map menu nav noembed noframes "
    "noscript object optgroup option progress meter script search select style svg template textarea title video".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status "
            "toolbar".split())
#: Words in classes and ids that name what is no part of an article.
NAMED = set(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adsense adslot banner banners breadcrumb "
    "breadcrumbs comment comments commentlist commentary cookie cookies consent copyright discussion disclaimer disqus "
    "feedback footer gdpr masthead menu menubar menus modal nav navbar navigation newsletter notice notices "
    "notification overlay pager pagination popup promo promos promoted promotion recommendations recommended related "
    "replies reply respond search share sharebar sharing sidebar sidebars signup skyscraper social sponsor sponsored "
    "sponsors subscribe subscription teaser teasers toolbar topbar widget widgets".split())
HEADS = {"header"}  # excluded outside articles only
COMMENTS = set("comment comments commentlist discussion disqus related replies reply respond teaser promo".split())
DENIED = {"has", "no", "not", "with", "without"}
SAYS_COMMENTS = re.compile(
    r"(\d+ )?(all |latest |readers?['’]?s?['’]? |user )?(comments?|replies|responses)( ?\(?\d+\)?)?:?"
    r"|leave a (reply|comment)|kommentare|commentaires|comentarios", re.I)
COMMENT_END = re.compile(r"--!?>")
UNENDED = re.compile(r"<[A-Za-z/!?]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Element:
    """An open element: why its text is excluded, if it is, whether it lies in an article (and in one that is not
    excluded itself), and the numbers of the innermost region and list around its text."""

    __slots__ = ("tag", "hard", "soft", "article", "inside", "region", "list", "own")

    def __init__(self, tag="", hard=False, soft=False, article=False, inside=False, region=-1, list_=-1, own=False):
        self.tag, self.hard, self.soft, self.article, self.inside = tag, hard, soft, article, inside
        self.region, self.list, self.own = region, list_, own


class Line:
    """Text of one block."""

    __slots__ = ("text", "tags", "linked", "tag", "hard", "soft", "inside", "region", "list")

    def __init__(self, text: str, tags: int, linked: int, top: Element):
        self.text, self.tags, self.linked, self.tag = text, tags, linked, top.tag
        self.hard, self.soft, self.inside, self.region, self.list = top.hard, top.soft, top.inside, top.region, top.list

    @property
    def link(self) -> bool:
        return self.linked >= LINKED * len(self.text)


def names(attributes: dict[str, str]) -> list[str]:
    """Words of class and id, without those that say that something else is beside the element."""
    found: list[str] = []
    for given in f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split():
        words = [w.lower() for w in WORDS.findall(given)]
        if not DENIED.intersection(words):
            found += words
    return found


def excluded(tag: str, attributes: dict[str, str], in_article: bool) -> tuple[bool, bool]:
    """Whether an element holds no part of an article, and whether it only may hold none (forms and page headers)."""
    if tag in ("html", "body"):
        return False, False
    if "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true":
        return True, False
    if HIDDEN.search(attributes.get("style") or ""):
        return True, False
    if tag in NEVER:
        return True, False
    role = (attributes.get("role") or "").lower()
    if tag == "main" or role in ("main", "article"):
        return False, False
    words = names(attributes)
    if tag == "article":
        return not COMMENTS.isdisjoint(words), False
    if not NAMED.isdisjoint(words) or (role in ROLES and not (role == "banner" and in_article)):
        return True, False
    head = tag == "header" or not HEADS.isdisjoint(words)
    return False, tag in ("form", "fieldset", "legend", "label") or (head and not in_article)


class Lines(HTMLParser):
    """Lines of one page, and its regions: tag, number of the first line and number behind the last one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.open, self.lines, self.regions = [Element()], Counter(), [], []
        self.parts, self.tags, self.linked, self.in_link = [], 0, 0, False

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i, report)  # the inherited method stops at unknown names

    def parse_html_declaration(self, i):
        if not self.rawdata.startswith("<!--", i):
            return super().parse_html_declaration(i)
        end = COMMENT_END.search(self.rawdata, i + 2 if self.rawdata.startswith(("<!-->", "<!--->"), i) else i + 4)
        return end.end() if end else len(self.rawdata)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, min(self.linked, len(text)), self.stack[-1]))
        self.parts, self.tags, self.linked = [], 0, 0

    def close_to(self, tags: set[str], border: set[str]) -> None:
        """End the innermost open element of ``tags`` unless one of ``border`` is met before."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                self.flush()
                self.leave(i)
                self.in_link = False
                return
            if tag in border:
                return

    def leave(self, depth: int) -> None:
        for e in self.stack[depth:]:
            self.open[e.tag] -= 1
            if e.own:
                self.regions[e.region][2] = len(self.lines)
        del self.stack[depth:]

    def handle_starttag(self, tag, attrs):
        attributes = dict(reversed(attrs))  # the first of a repeated name counts
        if tag in BLOCKS:
            self.flush()
            last = self.stack[-1].tag
            if last == "head" and tag not in ("title", "head") or last in HEADINGS and tag in HEADINGS:
                self.leave(len(self.stack) - 1)
            self.close_to({"p"}, HOLD_P)
        if tag in ENDS:
            self.close_to(*ENDS[tag])
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag == "a":
            self.in_link = "href" in attributes
        if tag in VOID:
            return
        top = self.stack[-1]
        hard, soft = excluded(tag, attributes, top.article)
        if tag in BLOCKS or hard or soft:
            if tag not in BLOCKS:
                self.flush()
            own, region, list_ = tag in REGIONS, top.region, top.list
            if own:
                region = len(self.regions)
                list_ = region if tag in LISTS else list_
                self.regions.append([tag, len(self.lines), None])
            article, inside = tag in ARTICLES, (tag in ARTICLES or top.inside) and not hard
            self.open[tag] += 1
            self.stack.append(Element(tag, top.hard or hard, top.soft or soft, top.article or article, inside, region,
                                      list_, own))

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.in_link = False
        self.close_to({tag}, set() if tag in ("body", "html", "table", "tr") else BORDERS - {tag})

    def handle_data(self, data):
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data)

    def read(self, page: str) -> list[Line]:
        # Nothing can end a tag behind the last ">": what opens there is no text.
        last = page.rfind(">") + 1
        tail = UNENDED.search(page, last)
        self.feed(page[:tail.start()] if tail else page)
        self.close()
        self.flush()
        self.leave(1)
        return self.lines


def smoothed(ratios: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    """Gaussian mean over neighbouring lines."""
    reach = int(3 * spread)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    return np.convolve(ratios, weights, "full")[reach:reach + len(ratios)] / np.convolve(
        np.ones(len(ratios)), weights, "full")[reach:reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Border of the clusters of high and low values: midway between their means; at most the values' deviation."""
    border = values.mean()
    for _ in range(50):
        high, low = values[values >= border], values[values < border]
        moved = (high.mean() + (low.mean() if len(low) else 0.0)) / 2 if len(high) else border
        if abs(moved - border) < 1e-9 * max(1.0, border):
            break
        border = moved
    return min(border, values.std()) if values.std() > 0 else border


def region(lines: list[Line], open_: list[bool], regions: list) -> tuple[int, int]:
    """First line of the element that holds the article, and the one behind its last, by the smoothed ratios."""
    ratios = np.array([max(0, len(x.text) - x.linked) / max(1, x.tags) if o else 0.0 for x, o in zip(lines, open_)])
    even = smoothed(ratios)
    high = (even >= threshold(even)) & np.array(open_)
    if not high.any():
        high = np.array(open_)
    weights = np.where(high, even * [len(x.text) for x in lines], 0.0)
    upto = np.concatenate([[0.0], np.cumsum(weights)])
    spans = [(tag, start, end, upto[end] - upto[start]) for tag, start, end in regions]  # outer ones come first
    articles = [x for x in spans if x[0] == "article" and x[3] > 0]
    if articles:
        return max(articles, key=lambda x: x[3])[1:3]
    found = (0, len(lines))
    for tag, start, end, weight in spans:
        if tag not in PARTS and weight >= NEARLY * upto[-1]:
            found = start, end
            if tag == "main":
                break
    return found


def main_lines(page: str | None) -> list[str]:
    """The blocks of a page's main text."""
    reader = Lines()
    lines = reader.read(page or "")
    for open_ in ([not (x.hard or x.soft) for x in lines], [not x.hard for x in lines], [x.inside for x in lines]):
        if any(open_):
            break
    else:
        return []
    start, end = region(lines, open_, reader.regions)
    only_links: dict[int, bool] = {}
    for x, o in zip(lines[start:end], open_[start:end]):
        if o and x.list >= 0:
            only_links[x.list] = only_links.get(x.list, True) and x.link
    while start and open_[start - 1] and lines[start - 1].tag in HEADINGS:
        start -= 1
    text, at = [], start
    while at < end:
        x = lines[at]
        if open_[at] and x.tag in HEADINGS and x.region >= 0 and SAYS_COMMENTS.fullmatch(x.text):
            at = reader.regions[x.region][2]  # to the end of what the heading stands in
            continue
        if open_[at] and not (x.list >= 0 and only_links.get(x.list)):
            text.append(x.text)
        at += 1
    return text


def main_text(page: str | None) -> str:
    return "\n\n".join(main_lines(page))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages with ``text``, their main text, and ``n_chars``, its code points, instead of the column of markup."""
    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    page = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_kept") if others else
                        F.lit(None).cast("int").alias("_kept"), page.alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, "_page"):
            texts = [main_text(p) for p in part.column("_page").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_kept"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["_kept", "text", "n_chars"])

    kind = StructType([rows.schema["_kept"]]).add("text", "string").add("n_chars", "long")
    found = rows.mapInArrow(run, kind)
    return found.select(*(F.col(f"_kept.`{c}`").alias(c) for c in others), "text", "n_chars")


def op13_tag_ratio(spark, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
