"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags, read in one linear pass and matched by a stack. Words score
above and tags below zero, with weights learned from pages whose text is known; the classes, ids and
roles of an element weigh on its tag as they do on those pages. One linear scan finds the contiguous
region with the highest sum, and its blocks are the text. Elements whose weight outdoes that of their
words add nothing to a region and are left out of it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import stored

#: Labelled pages that the weights are learned from: those whose ids hash lowest.
SAMPLE_PAGES = 400
_START = re.compile(r"<(?=[!?]|/?[a-z])", re.I)
_NAME = re.compile(r"<(/?)([a-z][a-z0-9:-]*)", re.I)
# a quote opens a value only after an equals sign; nothing is tried twice
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+>")
_LOOSE = re.compile(r"[^<>]*+(?:>|\Z)")
_NAMED = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "title"}
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.I) for n in _RAW}
_BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INNER = {"article", "main"}
#: Elements that are no article text by the meaning HTML gives them; labelled pages may say otherwise.
_ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "header"}
#: What HTML's meaning counts for: as much as this many labelled elements outside of the text.
_PRIOR = 10
_FLOOR = 0.05


def items(page: str) -> list[tuple[str, str, str]]:
    """(tag, "", attributes) and ("", text, "") in page order, without comments, scripts and the like.

    Linear in the page, whatever it holds: a quoted value that never ends is looked for once.
    """
    out, at, done, loose, last = [], 0, 0, False, page.rfind(">")
    while m := _START.search(page, at):
        i, raw = m.start(), None
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            end = len(page) if end < 0 else end + 3
            tag = None
        elif page[i + 1] in "!?":
            if i > last:
                break
            end, tag = page.find(">", i) + 1, None
        else:
            n = _NAME.match(page, i)
            rest = None if loose else _REST.match(page, n.end())
            if rest is None:
                loose = True  # the rest of the page has been looked through
                rest = _LOOSE.match(page, n.end())
            if rest is None:
                at = n.end()
                continue
            end, name = rest.end(), n[2].lower()
            tag = (n[1] + name, "", rest[0])
            if not n[1] and name in _RAW and not (name == "svg" and rest[0].endswith("/>")):
                raw = _RAW_END[name].search(page, end)
                end = page.find(">", raw.start()) + 1 if raw else 0
                end, tag = end or len(page), ("/" + name, "", "")
        if i > done:
            out.append(("", page[done:i], ""))
        if tag:
            out.append(tag)
        at = done = end
    if done < len(page):
        out.append(("", page[done:], ""))
    return out


def _ends(seq: list[tuple[str, str, str]]) -> dict[int, tuple[int, bool]]:
    """For every opening tag the place where its element ends, and whether a tag closes it there."""
    ends, stack, opened = {}, [], Counter()
    for i, (tag, _, rest) in enumerate(seq):
        if not tag or tag in _VOID or rest.endswith("/>") and tag not in _BLOCK and tag not in _ASIDE:
            continue
        if tag[0] != "/":
            stack.append(i)
            opened[tag] += 1
        elif opened[tag[1:]]:
            while True:
                j = stack.pop()
                opened[seq[j][0]] -= 1
                ends[j] = (i, seq[j][0] == tag[1:])
                if ends[j][1]:
                    break
    ends.update((j, (len(seq), False)) for j in stack)
    return ends


def _marks(tag: str, rest: str) -> set[str]:
    """An element's classes, ids and roles, without numbers: what its weight is learned by."""
    if len(rest) < 8:
        return set()
    names = " ".join(a or b or c for a, b, c in _NAMED.findall(rest)).lower()
    return {"." + w for w in (re.sub(r"[0-9]+", "", x).strip("-_") for x in names.split()) if w}


def _contexts(seq: list, weight: dict[str, float]) -> tuple[list[float], list[float]]:
    """For each item the weight of the elements around it, and what its own opening tag adds.

    An element that frames the page (over half of its words, with the first heading or, if there is
    none, the first paragraph) says nothing of an article inside it, and nothing at all if there is
    no such element on the page. Nor does an element that is never closed: by its name it ends with
    the element around it, by its marks at the next block.
    """
    ends, words = _ends(seq), [0]
    for tag, text, _ in seq:
        words.append(words[-1] + (0 if tag else len(text.split())))
    tags = [t for t, _, _ in seq]
    head = next((tags.index(t) for t in ("h1", "p") if t in tags), None)
    inner = any(t in _INNER for t in tags)
    around, own, stack = [], [], [(len(seq), False, 0.0, False, False)]
    for i, (tag, _, rest) in enumerate(seq):
        while len(stack) > 1 and (stack[-1][0] <= i or stack[-1][1] and tag in _BLOCK):
            stack.pop()
        _, _, now, firm, inside = stack[-1]
        adds = 0.0
        if i in ends:
            (end, closed), was = ends[i], now
            marks = min((weight.get(m, 0.0) for m in _marks(tag, rest)), default=0.0)
            name = weight.get("@" + tag, -math.log(_PRIOR + 1)) if tag in _ASIDE and not (tag == "header" and inside) else 0.0
            if tag in _INNER:
                inside = True
                now = now if firm else 0.0
            adds, short = min(marks, name), not closed and marks < 0 <= name
            frame = not short and 2 * (words[end] - words[i]) > words[-1] and (head is None or i <= head < end)
            if frame and not inner:
                adds = 0.0
            if adds < 0:
                now, firm = min(now, adds), firm or closed and not frame
            if adds < 0 or now != was or tag in _INNER:
                stack.append((end, short, now, firm, inside))
        around.append(now)
        own.append(adds)
    return around, own


def _hits(seq: list, known: str) -> tuple[list[str], list[int]]:
    flat = " ".join(known.split())
    texts = [" ".join(html.unescape(t).split()) for _, t, _ in seq]
    return texts, [i for i, t in enumerate(texts) if t.count(" ") >= 2 and t in flat]


def _marked(page: str, known: str) -> tuple[Counter, Counter]:
    """Marks and names of elements inside and outside the known text of a page.

    Inside are those with a run of three known words, outside those with three words of other text
    alone, or any text beyond the first and last known run.
    """
    seq, inside, outside = items(page), Counter(), Counter()
    texts, hits = _hits(seq, known)
    if not hits:
        return inside, outside
    good, bad, any_ = ([0], [0], [0])
    hit = set(hits)
    for i, t in enumerate(texts):
        good.append(good[-1] + (i in hit))
        bad.append(bad[-1] + (t.count(" ") >= 2 and i not in hit))
        any_.append(any_[-1] + bool(t))
    for i, (end, closed) in _ends(seq).items():
        tag, _, rest = seq[i]
        keys = _marks(tag, rest) | ({"@" + tag} if tag in _ASIDE else set())
        if not keys or not closed:
            continue
        if good[end] > good[i]:
            inside.update(keys)
        elif bad[end] > bad[i] or any_[end] > any_[i] and (end <= hits[0] or i > hits[-1]):
            outside.update(keys)
    return inside, outside


def _counts(page: str, known: str, weight: dict[str, float]) -> tuple[Counter, Counter]:
    """Tags and words inside and outside the stretch of a page that holds its known text."""
    seq = items(page)
    texts, hits = _hits(seq, known)
    inside, outside = Counter(), Counter()
    for i, ((tag, _, _), around) in enumerate(zip(seq, _contexts(seq, weight)[0])):
        if around < 0:
            continue
        into = inside if hits and hits[0] <= i <= hits[-1] else outside
        into[tag or "word"] += 1 if tag else len(texts[i].split())
    return inside, outside


def weights(inside: Counter, outside: Counter) -> dict[str, float]:
    """Log-odds of lying outside the text: negative for tags, positive and at most 1 for words.

    Marks (``.class``) and names (``@name``) of elements weigh only if they are oftener outside.
    """
    out = {}
    for t in {*inside, *outside}:
        v = math.log((outside[t] + 1 + (_PRIOR if t[0] == "@" else 0)) / (inside[t] + 1))
        out[t] = -max(0.0, v) if t[0] in ".@" else min(max(_FLOOR, -v), 1.0) if t == "word" else -max(_FLOOR, v)
    return out


def extract(page: str | None, weight: dict[str, float]) -> str:
    """The text of the best region: its blocks, one to a line; empty if there are no words."""
    seq, word = items(page or ""), weight.get("word", 1.0)
    around, own = _contexts(seq, weight)
    best = total = 0.0
    first, region = 0, (0, 0)
    for i, (tag, text, _) in enumerate(seq):
        if around[i] + word <= 0:
            continue
        if tag:
            total += weight.get(tag, -_FLOOR) + own[i]
        elif not text.isspace():
            total += word * len(text.split())
            if total > best:
                best, region = total, (first, i + 1)
        if total <= 0:
            total, first = 0.0, i + 1
    blocks, parts = [], []
    for i in [*range(*region), None]:
        tag, text, _ = seq[i] if i is not None else ("p", "", "")
        name = tag.lstrip("/")
        if not tag:
            parts.append(text if around[i] + word > 0 else " ")
        elif name in _BLOCK:
            block = " ".join(html.unescape("".join(parts)).split())
            parts = []
            if block:
                blocks.append(block)
        elif name == "br":
            parts.append(" ")
    return "\n".join(blocks)


def fit(pages: DataFrame, known: DataFrame) -> dict[str, float]:
    """Weights from pages whose text is known.

    ``known`` has page_id and text. At most ``SAMPLE_PAGES`` pages are learned from, first the marks
    of elements, then tags and words around them; without any, words weigh 1, tags a small equal
    amount and marks nothing.
    """
    picked = (pages.join(known.select("page_id"), "page_id", "left_semi").where("html is not null")
              .select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES))
    # both sides of the sample have at most SAMPLE_PAGES ids
    rows = stored(pages.join(F.broadcast(picked), "page_id").select("page_id", "html")
                  .join(F.broadcast(known.where("text is not null").join(F.broadcast(picked), "page_id")), "page_id")
                  .select("html", "text"), "labelled_pages")
    marks = weights(*_summed(rows, _marked))
    return marks | weights(*_summed(rows, lambda page, text: _counts(page, text, marks)))


def _summed(rows: DataFrame, counts: Callable) -> tuple[Counter, Counter]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page, text in zip(batch.column("html").to_pylist(), batch.column("text").to_pylist()):
                a, b = counts(page, text)
                inside += a
                outside += b
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (inside, outside))],
            names=["tag", "inside", "outside"])

    found = (rows.mapInArrow(tb.tidy(count), "tag string, inside long, outside long")
             .groupBy("tag").agg(F.sum("inside"), F.sum("outside")).collect())
    return Counter({r[0]: r[1] for r in found}), Counter({r[0]: r[2] for r in found})


def _extractor(weight: dict[str, float]) -> Callable:
    def extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [extract(p, weight) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())],
                                             names=["page_id", "url", "text"])
    return extractor


def texts(pages: DataFrame, weight: dict[str, float]) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of text).

    Null and empty pages, and pages without words, have an empty text. Character references are
    decoded, white space within a block is one space, blocks are joined by one line feed. Repeated
    rows and rows without id are read each for itself; other columns are not looked at.
    """
    slim = pages.select("page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    found = slim.mapInArrow(tb.tidy(_extractor(weight)), "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
