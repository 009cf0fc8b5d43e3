"""Operator 8, HTML extraction by consensus host paths.

* Each page is read into containers and text blocks. A container is scored by the text of the
  paragraphs in it (its own children fully, grandchildren by half), links and boilerplate
  not counted; the best one, raised to its parent while a sibling holds a good part of its text,
  or the article or main element around it, is the page's candidate.
* Pages vote, per host, for their candidate's generalised path: the tags from the root with
  their classes, digits generalised. Votes are counted in Spark with map-side combine.
* Every page is extracted again with its host's winning path; a page without such a container
  falls back to its own candidate.

Text is decoded after the markup is cut, white space in a block becomes one space, blocks are
trimmed and joined by a blank line. Left out: navigation, page headers, footers, asides, forms,
scripts, styles, hidden parts and elements whose class, id or role names them as such (ads,
menus, notices, sharing, related links). What a name says in part only
(``has-sidebar``), and a form, is kept when it holds the page's article or main or most of its
text; so is a part of an article whose name may mean two things (``search-engines``) and whose
text has few links. An element named so as a whole is kept when it holds main, or most of a page
that is empty without it. Hidden parts and reader comments never are, however long.

Defined cases: pages nested to any depth are read in time and memory in proportion (a path of
over ``PATH_CHARS`` characters is hashed); null html gives an empty text; a null url votes with the empty host; a page cut
off in a tag loses that tag only; ties between paths go to the higher summed score, then the
smaller path; repeated rows vote again and are extracted alike; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import md5
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import maybe_broadcast, stage
from rollwise.llm.urls import parts

BROADCAST_ROWS = 50_000
# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select title head".split())
SKIP = frozenset("nav footer aside form button dialog menu header".split())
CONTAINER = frozenset("html body div section article main td th center details".split())
PARAGRAPH = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dd dt figcaption caption summary address".split())
BLOCK = CONTAINER | PARAGRAPH | SKIP | frozenset("ul ol dl table thead tbody tfoot tr figure hr fieldset legend hgroup".split())
NEGATIVE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead cookie cookies consent notice gdpr popup modal overlay newsletter subscribe "
    "subscription signup share sharing social related recommended recommendations comment comments disqus respond widget toolbar "
    "pagination pager login search skip hidden".split()
)
#: of these, words that also name parts of an article (``search-engines``): text like an article's is read after all
AMBIGUOUS = frozenset("search menu notice header footer banner modal overlay hidden skip login pager popup navigation masthead toolbar respond".split())
#: reader comments: a name that starts or ends so, unless it only tells of them
COMMENTS = frozenset("comment comments commentlist commentarea commentform commentsection disqus responses replies".split())
TELLS = frozenset("no has with show hide open closed enabled disabled on off count link".split())
#: an ambiguously named part of an article is read with so many characters, so much of them outside links
LEAST_CHARS, UNLINKED = 60, 0.8
#: longer paths are told apart by a hash of what they begin with
PATH_CHARS = 400
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
WHOLE = frozenset(["html", "body", "article", "main"])
#: why an element is left out: never read again, named so as a whole, named so in part or a form
HIDDEN, NAMED, PARTLY = 3, 2, 1
#: a sibling with this share of the best container's text belongs to the candidate
RICH = 0.2
#: elements a start tag closes when one is open in the same container
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[a-z]+")


def _of_comments(name: str) -> bool:
    """Whether a class or id names a block of reader comments."""
    words = WORDS.findall(name)
    return bool(words) and not TELLS.intersection((words[0], words[-1])) and (words[0] in COMMENTS or words[-1] in COMMENTS)


class Page:
    """Containers (parent, path, tag, score) and text blocks (container, text) of one page."""

    def __init__(self, html: str) -> None:
        self.parent, self.path, self.tag, self.score = [-1], [""], ["#"], [0.0]
        self.blocks: list[tuple[int, str]] = []
        #: left-out elements with an ambiguous name inside an article
        self.maybe: set[int] = set()
        #: how many elements of each name are open
        self.count: Counter = Counter()
        #: every block with its weight: (container, text, weight, left-out element or 0, article or main around it)
        self.found: list[tuple[int, str, int, int, str]] = []
        #: left-out elements: (the one around it or 0, why)
        self.left = [(0, 0)]
        #: left-out elements that hold an article or main of their own, and which
        self.holders: dict[int, str] = {}
        #: open elements: (tag, container number, left-out element around or 0, inside a link, article or main around)
        self.open = [("#", 0, 0, False, "")]
        self.text: list[str] = []
        self.linked = 0
        at = 0
        while at < len(html):
            m = TOKEN.search(html, at)
            if m is None:
                self._add(html[at:])
                break
            if m.start() > at:
                self._add(html[at : m.start()])
            at = m.end()
            name = m[2] or m[6]
            if name is None or not (m[4] or m[8]):
                continue
            name = name.lower()
            if m[1] or m[5]:
                self._end(name)
            elif name in RAW and not (m[3] or m[7] or "").endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = close.end() if close else (len(html) if name != "head" else at)
            else:
                self._start(name, m[3] or m[7] or "")
        self._flush()
        self._settle()

    def _add(self, raw: str) -> None:
        _, _, left, link, _ = self.open[-1]
        if self.left[left][1] != HIDDEN:
            self.text.append(raw)
            if link:
                self.linked += len(raw)

    def _flush(self) -> None:
        """End the current block: its text is noted with the container it stands in."""
        if not self.text:
            return
        text = " ".join(unescape("".join(self.text)).split())
        linked, self.text, self.linked = self.linked, [], 0
        if not text:
            return
        _, box, left, _, around = self.open[-1]
        self.found.append((box, text, max(0, len(text) - linked), left, around))

    def _settle(self) -> None:
        """Decide which left-out elements are read after all, then give the blocks to their containers."""
        n = len(self.left)
        held, article, main, size = [0] * n, [0] * n, [0] * n, [0] * n
        worst = [0] * n  # the strongest reason around, the element's own included
        for i in range(1, n):
            worst[i] = max(self.left[i][1], worst[self.left[i][0]])
        plain = free = 0  # text outside NAMED elements; article text outside every left-out element
        for _, text, weight, left, around in self.found:
            plain += weight if worst[left] <= PARTLY else 0
            free += weight if around and not left else 0
            held[left] += weight
            size[left] += len(text)
            article[left] += weight if around else 0
            main[left] += weight if around == "main" else 0
        for i in range(n - 1, 0, -1):  # an element comes after the one around it
            for sums in (held, size, article, main):
                sums[self.left[i][0]] += sums[i]
        total = sum(f[2] for f in self.found)
        read = [True] + [False] * (n - 1)

        def choose(last_resort: bool) -> None:
            for i in range(1, n):
                up, why = self.left[i]
                if not read[up] or why == HIDDEN:
                    continue
                holds = inner_main[i] or (last_resort and 2 * held[i] > total)
                if why == PARTLY:
                    holds = holds or 2 * held[i] > plain or (inner[i] and article[i] and (not free or 2 * article[i] > total))
                    holds = holds or (i in self.maybe and held[i] >= max(LEAST_CHARS, UNLINKED * size[i]))
                read[i] = bool(holds)

        # An article or main around a left-out element does not make that element an article's holder.
        inner = [i in self.holders for i in range(n)]
        inner_main = [self.holders.get(i) == "main" and main[i] > 0 for i in range(n)]
        choose(False)
        if not any(read[f[3]] and f[2] for f in self.found):
            choose(True)
        for box, text, weight, left, _ in self.found:
            if read[left]:
                self.blocks.append((box, text))
                self.score[box] += weight
                if box:
                    self.score[self.parent[box]] += weight / 2

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text.append(" ")
            return
        if name in BLOCK:
            self._flush()
            self._close_implied({"p"} | CLOSES.get(name, set()))
        if name in VOID or attributes.endswith("/"):
            return
        _, box, left, link, around = self.open[-1]
        classes, bad, why, maybe, comments = "", False, PARTLY, True, False
        if attributes:
            for key, a, b, c in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), (a or b or c).lower()
                if key in ("class", "id"):
                    if key == "class":
                        classes = ".".join(sorted(re.sub(r"\d+", "0", x) for x in value.split()))
                    found = NEGATIVE.intersection(WORDS.findall(value))
                    bad, maybe = bad or bool(found), maybe and found <= AMBIGUOUS
                    comments = comments or any(map(_of_comments, value.split()))
                    why = max(why, NAMED if not NEGATIVE.isdisjoint(value.split()) else why)
                elif key == "role" and value in ROLES:
                    bad, why = True, max(why, PARTLY if value == "form" else NAMED)
                elif key == "style" and "display:none" in value.replace(" ", ""):
                    bad, why = True, HIDDEN
                elif key in ("hidden", "aria-hidden") and value != "false":
                    bad, why = True, HIDDEN
        in_article = bool(around)
        if comments and name not in ("html", "body", "main"):
            bad, why = True, HIDDEN  # never read, however long
        elif name in WHOLE:
            bad = False
        elif name == "header" or (bad and name in PARAGRAPH and name[0] == "h"):
            bad = not in_article  # an article's own heading is part of it
        elif name in SKIP:
            bad, why = True, max(why, PARTLY if name == "form" else NAMED)
        if name == "header":
            why = max(why, NAMED)
        if name in ("article", "main"):
            at = left
            while at and self.holders.get(at) not in ("main", name):
                self.holders[at] = name
                at = self.left[at][0]
            around = "main" if "main" in (name, around) else name
        if bad:
            self.left.append((left, max(why, HIDDEN if self.left[left][1] == HIDDEN else why)))
            left = len(self.left) - 1
            if in_article and maybe and why == PARTLY and name not in SKIP:
                self.maybe.add(left)
        if name in CONTAINER:
            self.parent.append(box)
            path = f"{self.path[box]}>{name}" + ("." + classes if classes else "")
            self.path.append(path if len(path) <= PATH_CHARS else "#" + md5(path.encode("utf-8", "replace")).hexdigest())
            self.tag.append(name)
            self.score.append(0.0)
            box = len(self.parent) - 1
        self.open.append((name, box, left, link or name == "a", around))
        self.count[name] += 1

    def _cut(self, i: int) -> None:
        """Close the open elements from the i-th on."""
        self.count.subtract(x[0] for x in self.open[i:])
        del self.open[i:]

    def _close_implied(self, names: set[str]) -> None:
        if not any(self.count[x] for x in names):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in names:
                self._cut(i)
                return
            if tag in CONTAINER or tag in ("ul", "ol", "dl", "table"):
                return

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        if not self.count[name]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag == name:
                self._cut(i)
                return
            if name not in BLOCK and tag in BLOCK:
                return

    def candidate(self) -> int:
        """The best container with its text-rich siblings, or the nearest article or main around it; 0 without text."""
        best = max(range(len(self.score)), key=lambda i: (self.score[i], -i))
        if self.score[best] <= 0:
            return 0
        whole = [0] * len(self.parent)  # text in a container and all containers in it
        for box, text in self.blocks:
            whole[box] += len(text)
        for i in range(len(whole) - 1, 0, -1):
            whole[self.parent[i]] += whole[i]
        rich: dict[int, list[int]] = defaultdict(list)
        for i in range(1, len(whole)):
            rich[self.parent[i]].append(i)
        at = best
        while self.parent[at] > 0 and self.tag[at] not in ("article", "main"):
            if any(i != at and whole[i] >= RICH * whole[at] for i in rich[self.parent[at]]):
                best = self.parent[at]
            at = self.parent[at]
        up = best
        while up > 0 and self.tag[up] not in ("article", "main"):
            up = self.parent[up]
        return up if up > 0 else best

    def extract(self, path: str | None) -> str:
        """The blocks under the containers with this path, or under the page's own candidate."""
        roots = {i for i, p in enumerate(self.path) if i and p == path} or {self.candidate()}
        inside = [i in roots for i in range(len(self.parent))]
        for i in range(1, len(inside)):
            inside[i] = inside[i] or inside[self.parent[i]]
        text = "\n\n".join(t for box, t in self.blocks if inside[box])
        return text or (self.extract(None) if path is not None and roots != {self.candidate()} else "")


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes, score) over every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple[str, str], list] = defaultdict(lambda: [0, 0])
            for host, html in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                page = Page(html.as_py() or "")
                box = page.candidate()
                if box:
                    v = seen[host, page.path[box]]
                    v[0] += 1
                    v[1] += int(page.score[box])
            rows = [(h, p, n, s) for (h, p), (n, s) in seen.items()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                names=["host", "path", "votes", "score"],
            )

    rows = pages.select(parts(F.col("url"))[0].alias("host"), F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(run, "host string, path string, votes long, score long")
    return found.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))


def winners(counted: DataFrame) -> DataFrame:
    """(host, win): each host's most voted path."""
    rank = F.struct(-F.col("votes"), -F.col("score"), F.col("path"))
    return counted.groupBy("host").agg(F.min_by("path", rank).alias("win"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    won = stage(winners(votes(pages)), "html-winners")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        parts(F.col("url"))[0].alias("host"),
    )
    rows = rows.join(maybe_broadcast(won, BROADCAST_ROWS), "host", "left").select("page_id", "url", "html", "win")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [Page(h.as_py() or "").extract(w) for h, w in zip(b.column(2), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
