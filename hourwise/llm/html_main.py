"""Main text of web pages by site template removal.

Every block element's subtree (its source with white space collapsed) is hashed;
Spark counts on how many different pages of its host each hash occurs; pages whose text is equal before the count are copies
and count once. Subtrees that recur on many pages of the host are template and are deleted, as are elements whose tag or role
says menu, header, footer, sidebar, notice, advert, form or reader comments, and containers whose class or id does. A paragraph, heading,
quotation or caption, which documents may share, goes only if it recurs and its name says so too.
If a page marks its article, the text is taken from there, and inside it lists and tables do not count as template either, and of the other containers
none that holds more than half of the main text, nor what is in such a one. Without an article size says nothing, as
a site's words may outweigh a short text: there only the count decides.

Null and empty pages give empty text. Pages without a host are counted as
one host. Repeated pages are extracted one by one. Broken markup never fails: unclosed
elements end with their parent or the page, and a self-closed one is empty; a script or style without its end tag reaches to the page's end.
Long and deep pages take linear time: an element's hash is made from its own source and its children's hashes. Only page_id, url and html are read.
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sized

#: A subtree is template if at least so many different pages of its host have it, however many pages the host has.
MIN_PAGES = 5

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*>", re.S | re.I)
#: Elements whose content is not markup, and any start or end tag of each.
RAW = {tag: re.compile(rf"<(/?){tag}\b[^>]*>?", re.I) for tag in ("script", "style", "textarea", "title", "iframe")}
#: Elements inside a line whose content is no text of the page.
HIDDEN = frozenset("noscript template svg select button object math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag ends, if open.
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Beyond these an implied end does not reach.
SCOPES = frozenset("ul ol dl table article section div main body html".split()) | HIDDEN
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr figcaption ul ol dl table tbody".split())
WRITING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
DROPPED = frozenset("head nav footer aside form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
NAMES = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside cookie cookies consent gdpr notice notices banner "
    "ad ads advert adverts advertisement adsense sponsored sponsor promo promotion popup modal overlay form search login signup subscribe "
    "newsletter comment comments disqus respond replies share sharing social breadcrumb breadcrumbs related widget pagination pager "
    "toolbar hidden".split())
#: Last words of a class or id that say where or how, not what: "comment-list" is a comment's, "form-factor" no form's.
PLACES = frozenset(
    "list box slot wrapper wrap container area bar block inner outer main top bottom left right primary secondary section group item items link links "
    "post posts article articles button buttons icon icons text content row unit panel".split())
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)


def named(value: str) -> bool:
    """Does a word of a class or id, up to its places, end in one of NAMES?"""
    for word in value.split():
        parts = [x for x in re.split(r"[_-]+", word) if x]
        while len(parts) > 1 and parts[-1] in PLACES:
            parts.pop()
        if parts and parts[-1] in NAMES:
            return True
    return False


def unwanted(tag: str, attributes: str, recurs: bool = False) -> bool:
    """Does the element's tag, role, class or id say that it is not main text? Those of a writing element count only if it recurs."""
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes:
        return False
    for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
        if hidden:
            return True
        value = (a or b or c).lower()
        if name.lower() == "role":
            if value in ROLES:
                return True
        elif (recurs or tag not in WRITING) and named(value):
            return True
    return False


class Page:
    """Block elements and texts of a page, in page order."""

    def __init__(self, source: str):
        self.source = source
        self.tags: list[str] = []
        self.attributes: list[str] = []
        self.starts: list[int] = []
        self.ends: list[int] = []
        # (open | close, block, 0), (hide | show, element inside a line, 0), (text, start, end), (space, 0, 0)
        self.events: list[tuple[str, int, int]] = []
        self._digests: list[int] = []
        self._parse()

    def _parse(self) -> None:
        source, events, stack = self.source, self.events, []
        tags = self.tags
        open_now: Counter[str] = Counter()

        def close(to: int, at: int) -> None:
            while len(stack) > to:
                i = stack.pop()
                open_now[tags[i]] -= 1
                self.ends[i] = at
                events.append(("show" if tags[i] in HIDDEN else "close", i, 0))

        def end_implied(tag: str, at: int) -> None:
            names = ENDS.get(tag, ())
            if not open_now["p"] and not any(open_now[name] for name in names):
                return
            for k in range(len(stack) - 1, -1, -1):
                name = tags[stack[k]]
                if name == "p" or name in names:
                    close(k, at)
                    if name != "p":
                        return
                elif name in SCOPES:
                    return

        def raw_end(tag: str, attributes: str, at: int) -> int:
            """Where an element that is not markup ends, given the end of its start tag."""
            empty = attributes.rstrip().endswith("/")
            for other in RAW[tag].finditer(source, at) if tag not in endless else ():
                if other[1]:
                    return other.end()
                if empty:
                    return at
            endless.add(tag)  # no end tag further on: searched once
            return len(source) if tag in ("script", "style") and not empty else at
        last = 0
        endless: set[str] = set()
        while m := TOKEN.search(source, last):
            at = m.start()
            if at > last:
                events.append(("text", last, at))
            last = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            attributes = m[3] or m[6] or ""
            if tag in RAW:
                if not (m[1] or m[4]):
                    last = raw_end(tag, attributes, last)
                continue
            if tag in HIDDEN and not (m[1] or m[4]):
                if not attributes.rstrip().endswith("/"):
                    events.append(("hide", len(tags), 0))
                    stack.append(len(tags))
                    open_now[tag] += 1
                    tags.append(tag)
                    self.attributes.append(attributes)
                    self.starts.append(at)
                    self.ends.append(last)
                continue
            if tag not in BLOCKS and tag not in HIDDEN:
                if tag == "br":
                    events.append(("space", 0, 0))
                continue
            if m[1] or m[4]:
                if not open_now[tag]:
                    continue
                for k in range(len(stack) - 1, -1, -1):
                    if tags[stack[k]] == tag:
                        close(k, last)
                        break
                    if tag == "p" and tags[stack[k]] in SCOPES:
                        break
                continue
            end_implied(tag, at)
            events.append(("open", len(tags), 0))
            tags.append(tag)
            self.attributes.append(attributes)
            self.starts.append(at)
            self.ends.append(last)
            if tag in VOID:
                events.append(("close", len(tags) - 1, 0))
            else:
                stack.append(len(tags) - 1)
                open_now[tag] += 1
        if last < len(source):
            events.append(("text", last, len(source)))
        close(0, len(source))

    def digest(self, i: int) -> int:
        """Signed 64-bit hash of an element's subtree: of its own source between its children and of their hashes."""
        if not self._digests:
            self._digests = [0] * len(self.tags)
            stack, cursor = [], 0

            def source_until(at: int) -> None:
                if stack:
                    stack[-1].update(" ".join(self.source[cursor:at].split()).encode("utf-8", "surrogatepass"))
            for kind, a, _ in self.events:
                if kind in ("open", "hide"):
                    source_until(self.starts[a])
                    cursor = self.starts[a]
                    stack.append(xxhash.xxh3_64())
                elif kind in ("close", "show"):
                    source_until(self.ends[a])
                    cursor = self.ends[a]
                    done = stack.pop()
                    self._digests[a] = done.intdigest() - (1 << 63)
                    if stack:
                        stack[-1].update(b"\0" + done.digest())
        return self._digests[i]

    def subtrees(self) -> set[int]:
        """Hashes of the elements that may be template: all but the page's frame and its article."""
        return {self.digest(i) for i, t in enumerate(self.tags)
                if t not in ("html", "head", "body", "article", "main", "hr") and t not in HIDDEN}

    def content(self) -> int:
        """Signed 64-bit hash of the text that is left before template is known; equal on copies of a page."""
        return xxhash.xxh3_64_intdigest(self.text(frozenset()).encode("utf-8", "surrogatepass")) - (1 << 63)

    def roots(self) -> set[int]:
        """The elements that hold the main text, if the page marks them."""
        return {i for i, t in enumerate(self.tags) if t == "article" and not unwanted(t, self.attributes[i])} \
            or {i for i, t in enumerate(self.tags) if t == "main"}

    def most(self, roots: set[int]) -> set[int]:
        """Elements that hold more than half of the text of the roots; what is dropped by name does not count."""
        own, opened, total, skip, inside = [0] * len(self.tags), [0] * len(self.tags), 0, 0, 0
        for kind, a, b in self.events:
            if kind == "text":
                if inside and not skip:
                    total += len("".join(self.source[a:b].split()))
            elif kind in ("hide", "show"):
                skip += 1 if kind == "hide" else -1
            elif kind != "space":
                step = 1 if kind == "open" else -1
                if a in roots:
                    inside += step
                elif unwanted(self.tags[a], self.attributes[a]) and not (self.tags[a] == "header" and inside):
                    skip += step
                if step > 0:
                    opened[a] = total
                else:
                    own[a] = total - opened[a]
        return {i for i, n in enumerate(own) if 2 * n > total}

    def text(self, template: frozenset[int] | set[int]) -> str:
        """Main text: blocks joined by an empty line."""
        roots = self.roots()
        most = self.most(roots) if roots and template else frozenset()
        blocks: list[str] = []
        now: list[str] = []
        # elements open that are dropped; that are roots; that are the article's header; that recur but hold most of the text
        skip, inside, header, kept, hidden = 0, 0, 0, 0, 0
        marks: dict[int, tuple[int, int, int, int]] = {}

        def flush() -> None:
            if now:
                block = " ".join(entities.unescape("".join(now)).split())
                if block:
                    blocks.append(block)
                now.clear()
        for kind, a, b in self.events:
            if kind == "text":
                if not skip and (inside or not roots):
                    now.append(self.source[a:b])
            elif kind == "space":
                now.append(" ")
            elif kind in ("hide", "show"):
                step = 1 if kind == "hide" else -1
                skip, hidden = skip + step, hidden + step
            elif kind == "open":
                if not hidden:  # a block inside a hidden element does not end the line around it
                    flush()
                tag = self.tags[a]
                root = a in roots
                title = tag == "header" and inside
                seen = bool(template) and not root and not title and not skip and tag not in ("html", "body") and self.digest(a) in template
                recurs = seen and not kept and tag not in (PLAIN if inside else WRITING)
                keep = recurs and inside > 0 and a in most
                bad = not root and not title and (
                    tag == "header" or unwanted(tag, self.attributes[a], seen) or header and tag == "p" or recurs and not keep)
                marks[a] = (bad, root, title, keep)
                skip, inside, header, kept = skip + bad, inside + root, header + title, kept + keep
            else:
                if not hidden:
                    flush()
                bad, root, title, keep = marks[a]
                skip, inside, header, kept = skip - bad, inside - root, header - title, kept - keep
        flush()
        return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)


def blocks(pages: DataFrame) -> DataFrame:
    """(p1, p2, host, content, subtrees): key of each row, hash of its host and of its text, and its blocks. ``pages`` has p1 and p2."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(html or "") for html in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([x.content() for x in found], pa.int64()),
                 pa.array([list(x.subtrees()) for x in found], pa.list_(pa.int64()))], ["p1", "p2", "host", "content", "subtrees"])
    return pages.select("p1", "p2", F.xxhash64("host").alias("host"), "html").mapInArrow(count, "p1 long, p2 long, host long, content long, subtrees array<long>")


def templates(seen: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, subtree): subtrees that recur across the host's different pages. ``seen`` is that of ``blocks``."""
    once = seen.select("host", "content", F.explode("subtrees").alias("subtree")).distinct()
    return once.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).select("host", "subtree")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    # 128-bit key of a row; copies of a page differ in id, so that they are dealt over all tasks
    named = pages.select("page_id", "url", host_of(pages["url"]).alias("host"), "html", F.xxhash64("page_id", "url", "html").alias("p1"),
                         F.xxhash64(F.lit(1), "html", "url", "page_id").alias("p2"))
    seen = materialize(blocks(named), "page-blocks")
    found = materialize(templates(seen, min_pages).select(F.col("host").alias("__host"), F.col("subtree").alias("__subtree")), "templates")
    # each page's own recurring blocks, so that no task holds a host's
    single = seen.select("p1", "p2", "host", F.explode("subtrees").alias("subtree"))
    own = (single.join(sized(found), (F.col("host") == F.col("__host")) & (F.col("subtree") == F.col("__subtree")))
           .groupBy("p1", "p2").agg(F.collect_set("subtree").alias("subtrees")))
    with_templates = named.join(own, ["p1", "p2"], "left").select("page_id", "url", "html", "subtrees")
    kind = with_templates.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(html or "").text(set(own or ()))
                     for html, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return with_templates.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
