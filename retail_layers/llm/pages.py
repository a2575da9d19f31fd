"""Main text of web pages: block structure, and a suffix array per host for boilerplate.

A page is cut into blocks. Parts that are never article (menus, page headers and footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) are known by their
elements, roles and class names. Where a page marks its article (``article``, ``main`` or a
content class), its blocks are the candidates, else all that are left. The token streams of
a host's pages are one text. Its suffixes are sorted by their tokens, and every suffix is
compared with its neighbours in that order; the length in common is counted up to ``WIDTH``
tokens, and a longer repeat goes on in the suffixes that begin inside it.

Without a marked article, all suffixes are sorted: tokens that begin like a suffix of another
page for ``LONG`` tokens are boilerplate, and the runs left over are the text. In a marked
article only whole blocks are judged, as articles of a host do share passages, so its
suffixes are taken from the blocks' begins on, ``WIDTH`` tokens apart, and ``WIDTH`` before
their ends. A block of ``LONG`` tokens or more is boilerplate if more than half of the host's
pages (``MANY`` at least) have all of these strings in their articles, unless that takes half
of an article: such pages are copies of each other.

Scale: suffixes are dealt by host and first ``LONG`` tokens and streamed in sorted order, so
a host with a third of all pages spreads over all tasks. Only rows of one page are held while
a run of equal suffixes is streamed. Texts meet what is repeated on their page by a
broadcast while that is small.

Defined cases: a missing html counts as empty and gives an empty text; a missing url is a
host of its own; the same html under several ids or urls is one page and no evidence of
repetition; extra columns are left alone.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.llm.neardup import Hashing, mixed
from retail_layers.operators.skew import if_small
from retail_layers.scratch import keep

LONG = 8
# So many tokens of a suffix are compared, each as two bytes.
WIDTH = 16
# Fewer pages are no evidence against a marked article.
MANY = 4
# Elements by what they mean.
NEVER = frozenset("head title script style noscript template svg iframe object nav footer aside form button select textarea dialog menu".split())
RAW = frozenset("script style noscript template svg iframe textarea title".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SOFT = frozenset("p li dt dd td th tr option".split())
ARTICLE_CLASSES = frozenset("article articlebody post postbody entry story content maincontent".split())
CHROME_CLASSES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
    comments commentlist cookie cookies consent disqus footer menu modal nav navbar navigation newsletter notice notices
    popup promo related share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split())
# a name of several words is chrome where each of them is, or says nothing but where on the page it stands
NEUTRAL = frozenset("site page main primary secondary top bottom left right global list container wrapper bar block inner links".split())
READERS_CLASSES = frozenset("ad ads advert adverts advertisement advertising comment comments commentlist disqus sponsor sponsored".split())
WHOLE = frozenset("html body main article".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*))?")
ASKED = frozenset("class id role itemprop hidden aria-hidden".split())


def _is_chrome(names: str, classes: frozenset[str]) -> bool:
    """Whether one of the whole names, which may be of several words, is of these classes."""
    for one in names.split():
        words = {w for w in re.split(r"[_-]+", one) if w}
        if words & classes and words <= classes | NEUTRAL:
            return True
    return False


def _meaning(name: str, attributes: str, forms: bool = True) -> str:
    """What an element holds: chrome, article, or nothing in particular."""
    if name in NEVER and (forms or name != "form"):
        return "chrome"
    if attributes:
        held = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes) if k.lower() in ASKED}
        if held:
            # what holds the whole page or its article is only left out as a reader's or an advertiser's
            classes = READERS_CLASSES if name in WHOLE else CHROME_CLASSES
            if name not in ("html", "body") and (
                    _is_chrome(f"{held.get('class', '')} {held.get('id', '')}", classes)
                    or held.get("role") in CHROME_ROLES and (forms or held["role"] not in ("form", "search"))
                    or "hidden" in held or held.get("aria-hidden") == "true"):
                return "chrome"
            if held.get("role") == "main" or held.get("itemprop") == "articlebody":
                return "article"
            joined = {re.sub(r"[\s_-]", "", x) for x in f"{held.get('class', '')} {held.get('id', '')}".split()}
            if name in ("div", "section", "td") and joined & ARTICLE_CLASSES:
                return "article"
    return "article" if name in ("article", "main") else ""


def blocks(page: str | None, forms: bool = True) -> list[tuple[str, str]]:
    """(where, text) of the page's non-empty blocks in order; where: article, chrome or other.
    Without ``forms``, forms are no chrome, only what is filled in and pressed is."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and what they hold
    parts: list[str] = []
    begun = False
    page = page or ""

    def close() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            kinds = [kind for _, kind in stack]
            out.append(("chrome" if "chrome" in kinds else "article" if "article" in kinds else "other", text))

    def text(begin: int, end: int) -> None:
        if begin < end:
            parts.append(references.unescape(page[begin:end]))

    at = 0
    while True:
        tag = TAG.search(page, at)
        if not tag:
            text(at, len(page))
            close()
            return out
        text(at, tag.start())
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue  # a comment or declaration
        if tag[1]:
            if name in BLOCKS:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if stack[k][1] == "chrome":
                        close()
                    del stack[k:]
                    break
                if stack[k][1] == "article":
                    break  # an end tag without its begin does not end the article
            continue
        if name in RAW and not tag[3].rstrip().endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in BLOCKS:
            close()
            if stack and stack[-1][0] in SOFT:
                stack.pop()  # such an element ends where the next block begins
        elif name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        kind = _meaning(name, tag[3], forms)
        if name == "header" and not any(k == "article" for _, k in stack):
            kind = "chrome"
        if kind == "chrome" and name not in BLOCKS:
            close()
        if kind == "article" and not begun:  # menus and the like that were never closed end where the first article begins
            stack, begun = [(n, k) for n, k in stack if k != "chrome"], True
        if name in BLOCKS and name not in SOFT or kind:
            stack.append((name, kind))


def structured(page: str | None) -> tuple[bool, list[str], list[str]]:
    """Whether the page marks its article, the article's or candidate blocks, and all other blocks."""
    found = blocks(page)
    if page and found and all(kind == "chrome" for kind, _ in found):
        found = blocks(page, forms=False)  # some sites put a form around everything
    marked = any(kind == "article" for kind, _ in found)
    wanted = "article" if marked else "other"
    return marked, [t for k, t in found if k == wanted], [t for k, t in found if k != wanted]


def _codes(tokens: np.ndarray) -> np.ndarray:
    """The first ``WIDTH`` tokens of every suffix, two bytes each; 0 is behind the last token."""
    codes = np.maximum(tokens & np.uint64(0xFFFF), np.uint64(1)).astype(">u2")
    return sliding_window_view(np.r_[codes, np.zeros(WIDTH, ">u2")], WIDTH)


def _strings(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the strings that cover the blocks of ``LONG`` tokens or more; blocks have these sizes."""
    places, needs, at = [], [], 0
    for size in sizes:
        if size >= LONG:
            begins = [*range(0, max(size - WIDTH, 0), WIDTH), max(size - WIDTH, 0)]
            places += [at + b for b in begins]
            needs += [min(size, WIDTH)] * len(begins)
        at += size
    return np.array(places, np.int64), np.array(needs, np.int64)


def _sizes(parts: list[str]) -> list[int]:
    return [p.count(" ") + 1 for p in parts]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, codes, page, place, need: suffixes of a page's streams. In marked articles ``need`` is how
    many tokens have to repeat, elsewhere 0; place is -1 where a suffix is evidence only."""
    h = Hashing()
    for batch in batches:
        found = []
        for host, page, content in zip(*(batch.column(k).to_pylist() for k in range(3))):
            marked, inside, outside = structured(content)
            for asked, texts in ((True, inside), (False, outside)):
                codes = _codes(h.word_hashes(" ".join(texts)))
                if asked and marked:
                    place, need = _strings(_sizes(texts))
                else:
                    place = np.arange(max(len(codes) - LONG, 0))
                    need = np.zeros(len(place), np.int64)
                if len(place):
                    found.append((np.full(len(place), host), codes[place], np.full(len(place), page),
                                  place if asked else np.full(len(place), -1), need))
        if found:
            host, codes, page, place, need = (np.concatenate(x) for x in zip(*found))
            ends = np.arange(len(codes) + 1, dtype=np.int32) * (2 * WIDTH)
            binary = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(host), binary, pa.array(page), pa.array(place), pa.array(need)],
                                             ["host", "codes", "page", "place", "need"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted suffixes (host, codes, page, place, need) with the lengths in common with the one before and the one after."""
    held, first = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, WIDTH)
        host, page, place, need = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4))
        rows = [host, codes, page, place, need]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        host, codes = rows[:2]
        equal = (codes[1:] == codes[:-1]) & (codes[1:] != 0) & (host[1:] == host[:-1])[:, None]
        between = np.where(equal.all(1), WIDTH, equal.argmin(1))
        before = np.r_[first, between]
        yield *(x[:-1] for x in rows), before[:-1], between
        held, first = [x[-1:] for x in rows], before[-1]
    if held is not None:
        yield *held, np.array([first]), np.array([0])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes: page and place of those that begin like one of another page, and of strings
    in marked articles that occur again, these with host and a name of the string."""
    strings: list[pa.RecordBatch] = []
    names = ["page", "place", "host", "string"]

    def runs() -> Iterator[pa.RecordBatch]:
        number = 0
        for host, codes, page, place, need, before, after in _common(batches):
            again = (need > 0) & (np.maximum(before, after) >= need)
            string = host[again].astype(np.uint64) + need[again].astype(np.uint64)
            for k in range(WIDTH):
                string = mixed(string + np.where(k < need[again], codes[again, k], 0).astype(np.uint64) * np.uint64(2 * k + 3))
            strings.append(pa.RecordBatch.from_arrays([pa.array(x) for x in (page[again], place[again], host[again], string.view(np.int64))], names))
            run = number + np.cumsum(before < LONG)
            number = run[-1] if len(run) else number
            every = need == 0
            yield pa.RecordBatch.from_arrays([pa.array(x[every]) for x in (host, run, page, place)], ["host", "tokens", "page", "place"])

    for batch in _repeated(runs()):
        none = pa.nulls(batch.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, none, none], names)
        while strings:
            yield strings.pop()


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of suffixes sorted by host, with the number of the run of those that begin alike: those asked for that begin like one
    of another page. A batch for each batch."""
    last, first_page, several = None, 0, False
    held: list[int] = []  # places asked for in the current run, as long as it has one page
    for batch in batches:
        if not batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["page", "place"])
            continue
        host, tokens, page, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        new = np.r_[last is None or (host[0], tokens[0]) != last, (host[1:] != host[:-1]) | (tokens[1:] != tokens[:-1])]
        run = np.cumsum(new)
        first = np.r_[first_page, page[new]]
        many = np.zeros(run[-1] + 1, bool)
        many[run[page != first[run]]] = True
        late = bool(many[0] and not several)
        many[0] |= several
        send = many[run] & (place >= 0)
        pages, places = page[send], place[send]
        if late and held:
            pages, places = np.r_[pages, np.full(len(held), first_page)], np.r_[places, held]
        if run[-1] or late:
            held = []
        several, first_page, last = bool(many[-1]), first[-1], (host[-1], tokens[-1])
        if not several:
            held += place[(run == run[-1]) & (place >= 0)].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(pages), pa.array(places.astype(np.int64))], ["page", "place"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", content: str = "html") -> DataFrame:
    """Per page: page_id, url, text (blocks joined by line feeds), marked (the page marks its article)."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(content).alias("_html"),
                        F.xxhash64(host).alias("_host"), F.xxhash64(content).alias("_page"))

    @F.pandas_udf("marked boolean, text string")
    def parsed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(marked, "\n".join(inside)) for marked, inside, _ in map(structured, texts)], columns=["marked", "text"])

    @F.pandas_udf("string")
    def left(marked: pd.Series, texts: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else (_without_blocks if m else _without)(t.split("\n") if t else [], p)
                          for m, t, p in zip(marked, texts, places)], dtype=object)

    found = keep(
        rows.select("_host", "_page", "_html").mapInArrow(_suffixes, "host bigint, codes binary, page bigint, place bigint, need bigint")
        .repartition("host", F.substring("codes", 1, 2 * LONG)).sortWithinPartitions("host", "codes", "page", "place", "need")
        .mapInArrow(_shared, "page bigint, place bigint, host bigint, string bigint")
    )
    strings = found.where(F.col("string").isNotNull())
    sizes = rows.select(F.col("_host").alias("host"), "_page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("_pages"))
    common = (
        strings.groupBy("host", "string").agg(F.count_distinct("page").alias("_held")).where(F.col("_held") >= MANY)
        .join(sizes, "host").where(2 * F.col("_held") > F.col("_pages")).select("host", "string")
    )
    covered = keep(
        found.where(F.col("string").isNull()).unionByName(strings.join(if_small(keep(common)), ["host", "string"], "left_semi"))
        .groupBy(F.col("page").alias("_page")).agg(F.collect_set("place").alias("_places"))
    )
    read = rows.withColumn("_p", parsed.asNondeterministic()("_html")).select("page_id", "url", "_page", "_p.*")
    judged = read.join(if_small(covered), "_page", "left")
    asked = F.col("_places").isNotNull()
    text = F.coalesce(left("marked", F.when(asked, F.col("text")), "_places"), F.col("text"))
    return judged.select("page_id", "url", text.alias("text"), "marked")


def _without_blocks(parts: list[str], places) -> str:
    """The blocks without those whose strings are all among ``places``, unless these are half of all tokens."""
    sizes, gone, at = _sizes(parts), set(places), 0
    kept = []
    for size in sizes:
        mine = _strings([size])[0] + at
        kept.append(not len(mine) or not gone.issuperset(mine.tolist()))
        at += size
    if 2 * sum(s for s, k in zip(sizes, kept) if not k) >= at:
        return "\n".join(parts)
    return "\n".join(p for p, k in zip(parts, kept) if k)


def _without(parts: list[str], places) -> str:
    """The blocks without the tokens that suffixes at ``places`` cover."""
    if places is None or not len(places):
        return "\n".join(parts)
    words = [p.split() for p in parts]
    total = sum(map(len, words))
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, np.asarray(places, np.int64), 1)
    np.add.at(edge, np.asarray(places, np.int64) + LONG, -1)
    gone, at, out = np.cumsum(edge) > 0, 0, []
    for ws in words:
        left = " ".join(w for w, g in zip(ws, gone[at:at + len(ws)]) if not g)
        at += len(ws)
        if left:
            out.append(left)
    return "\n".join(out)
