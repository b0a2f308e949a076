"""Main text of web pages: a suffix array over each host, and element roles.

A page is read as blocks of text. Blocks of elements whose role is navigation, advert,
form, comment and the like are not text; blocks inside an article (or main) element are,
and where a page has one, blocks outside it are not. The token streams of what is left of
every page go to the suffix array of its host, which decides which of it is boilerplate:

* Inside an article, a substring of ``RUN`` tokens that stands in the articles of more than
  half of the host's distinct pages is the host's template (a notice, a pitch), and a block
  that such substrings cover leaves. Fewer pages do not count: near copies and common lines
  share passages that are their text. A host needs ``TEMPLATE_PAGES`` distinct pages.
* On a page without an article element roles say nothing for a block, so substrings of
  ``RUN`` tokens that occur on two distinct pages of that kind are boilerplate, and the
  unique runs that remain are kept.

Pages of one host whose blocks are all equal count as one page here, so copies keep their
text.

Scale: a host may hold a third of all pages, so its streams are not collected: the windows
of a stream go, as short contexts, to the task of their host and anchor (the token trigram
of least hash), and equal contexts are counted before that shuffle. Each task sorts the
suffixes of its contexts. Equal windows have equal anchors, so no repeat is missed. Of
articles, anchors alone are counted first, eight bytes each; only contexts whose anchor
stands on enough pages for a template are made of places. Articles are parsed three times
rather than kept on disk.

Defined cases: a null or empty page has an empty text; a null url counts as one host;
rows with equal page ids and no article count as one page, a null id as page -1; markup cut
off at the end of a page ends there; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.batches import prefix_hash, signed, slices, span_hash, windows
from helioframe.session import broadcast_if_small, discard, stage

RUN = 8  # tokens
ANCHOR = 3
CONTEXTS = 20_000  # sorted together, in whole anchors
TEMPLATE_PAGES = 10  # distinct pages of a host, below which more than half of them says little
PAGES = 500  # parsed together
_U = np.uint64

# Element names of the HTML standard by their part in a page.
RAW = "script style noscript template textarea title iframe object svg math select"
OUTSIDE = "nav footer aside form menu dialog button head"
CONTENT = "article main"
BREAKS = (
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr caption blockquote pre section article main"
    " header footer nav aside figure figcaption address form fieldset details summary hr body html head menu dialog"
)
STACKED = "div section article main header footer nav aside form menu dialog ul ol table figure button head details span"
SPACES = "br td th img"
HINTS = (
    "ad ads advert advertisement banner cookie consent notice menu nav navbar navigation breadcrumb breadcrumbs sidebar"
    " comment comments footer header masthead share social related promo sponsor sponsored popup modal newsletter subscribe"
)
_RAW, _OUTSIDE, _CONTENT = set(RAW.split()), set(OUTSIDE.split()), set(CONTENT.split())
_BREAKS, _STACKED, _SPACES, _HINTS = set(BREAKS.split()), set(STACKED.split()), set(SPACES.split()), set(HINTS.split())
_PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW.split()) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9-]*)(?P<attrs>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


def _hinted(attrs: str) -> bool:
    named = {w for m in _NAMES.finditer(attrs) for w in re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower())}
    return bool(named & _HINTS)


def blocks_of(page: str | None) -> tuple[list[str], bool]:
    """Blocks of text outside the known page furniture, in page order, and whether an
    article was found; if so, only its blocks are given."""
    found: list[tuple[str, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, inside content, dropped
    content = dropped = False

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            found.append((text, content))

    for part in _PART.finditer(page or ""):
        if part["text"] is not None:
            if not dropped:
                held.append(part["text"])
            continue
        name = (part["name"] or "").lower()
        if not name:
            continue
        if name in _SPACES:
            held.append(" ")
            continue
        if name in _BREAKS:
            flush()
        if part["close"]:
            if any(name == s[0] for s in stack):
                while stack.pop()[0] != name:
                    pass
                content, dropped = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        elif name in _STACKED and not part["attrs"].endswith("/"):
            attrs = part["attrs"]
            out = name in _OUTSIDE or name == "header" and not content or _hinted(attrs) and name not in _CONTENT
            if out or dropped or attrs and _HIDDEN.search(attrs):
                flush()
                dropped = True
            content = content or name in _CONTENT
            stack.append((name, content, dropped))
    flush()
    sure = any(c for _, c in found)
    return [t for t, c in found if c or not sure], sure


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every token; the texts are not empty and single spaces part their tokens."""
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    spaces = np.flatnonzero(data == ord(" "))
    start, end = np.append(0, spaces + 1), np.append(spaces, len(data))
    return span_hash(prefix_hash(data), start, end), np.repeat(np.arange(len(texts)), [t.count(" ") + 1 for t in texts])


def _anchors(tokens: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors of all windows, with the first and past the last token of the windows of each."""
    n = len(tokens) - RUN + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    inside = np.lib.stride_tricks.sliding_window_view(windows(tokens, ANCHOR), RUN - ANCHOR + 1)
    whole = np.flatnonzero(text[:n] == text[RUN - 1 :])
    at = inside[whole].argmin(1) + whole
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else whole
    last = np.append(new[1:], len(at)) - 1 if len(at) else whole
    return at[new], whole[new], whole[last] + RUN


def _surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of a page with an article; row and blocks of another."""
    for batch in batches:
        for first in range(0, batch.num_rows, PAGES):
            part = batch.slice(first, PAGES)
            both = [blocks_of(t) for t in part.column("html").to_pylist()]
            texts = [t for b, sure in both if sure for t in b]
            page = np.repeat(np.arange(len(both)), [len(b) if sure else 0 for b, sure in both])
            tokens, text = _tokens(texts)
            at, start, _ = _anchors(tokens, text)
            grams = windows(tokens, ANCHOR)
            pairs = np.unique(np.stack([page[text[start]].astype(np.uint64), grams[at]]), axis=1) if len(at) else np.zeros((2, 0), np.uint64)
            ends = np.searchsorted(pairs[0], np.arange(len(both) + 1, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array([None if sure else i for i, (_, sure) in enumerate(both)], pa.int64())),
                 part.column("page"), part.column("host"), pa.array([None if sure else b for b, sure in both], pa.list_(pa.string())),
                 pa.array([sure for _, sure in both]), pa.array([_key("\n\n".join(b)) for b, _ in both], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(pairs[1])))],
                names=["row", "page", "host", "blocks", "sure", "body", "anchors"],
            )


def _context_rows(texts: list[str]) -> tuple[np.ndarray, list[pa.Array]]:
    """Windows of one anchor as one run of token hashes: text number, then a, c, s and tokens of each run."""
    tokens, text = _tokens(texts)
    at, start, past = _anchors(tokens, text)
    runs = span_hash(prefix_hash(tokens.astype("<u8").view(np.uint8)), start * 8, past * 8) if len(at) else np.zeros(0, np.uint64)
    ends = np.append(0, np.cumsum(past - start))
    flat = np.arange(ends[-1]) + np.repeat(start - ends[:-1], past - start)
    place = start - np.searchsorted(text, text[start])
    return text[start], [
        pa.array(signed(windows(tokens, ANCHOR)[at])), pa.array(signed(runs)), pa.array(place.astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(tokens[flat]))),
    ]


def _article_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the blocks of pages with an article; a block goes by its hash."""
    for batch in batches:
        for first in range(0, batch.num_rows, PAGES):
            part = batch.slice(first, PAGES)
            pages = [(i, b) for i, (b, sure) in enumerate(blocks_of(t) for t in part.column("html").to_pylist()) if sure]
            texts = [t for _, b in pages for t in b]
            page = np.repeat([i for i, _ in pages], [len(b) for _, b in pages]).astype(np.int64)
            body = np.repeat(np.array([_key("\n\n".join(b)) for _, b in pages], np.int64), [len(b) for _, b in pages])
            block, size = np.array([_key(t) for t in texts], np.int64), np.array([t.count(" ") + 1 for t in texts], np.int32)
            text, columns = _context_rows(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("host").take(pa.array(page[text])), pa.array(body[text]), pa.array(block[text]), pa.array(size[text]), *columns],
                names=["host", "body", "block", "size", "a", "c", "s", "tokens"],
            )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of blocks that are rows."""
    for batch in slices(batches, "text"):
        text, columns = _context_rows(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(text)) for c in ("host", "page", "body", "block")] + columns,
            names=["host", "page", "body", "block", "a", "c", "s", "tokens"],
        )


def repeated_runs(contexts: list[np.ndarray], low: np.ndarray, high: np.ndarray, run: int = RUN) -> list[np.ndarray]:
    """For each context, which of its windows of ``run`` tokens occur on two pages.

    A suffix array over all contexts: ranks of suffixes by doubling, cut at the end of
    their context. Rows that share ``run`` tokens form an interval of the array; it is
    repeated when the least and the largest page of its rows differ.
    """
    sizes = np.array([len(c) for c in contexts])
    width = int(sizes.max())
    table = np.zeros((len(contexts), width), np.uint64)
    inside = np.arange(width) < sizes[:, None]
    _, codes = np.unique(np.concatenate(contexts), return_inverse=True)
    table[inside] = codes.astype(np.uint64) + _U(1)
    rank, span = table, 1
    while span < run:
        step = min(span, run - span)
        joined = rank << _U(32)
        joined[:, : width - step] |= rank[:, step:]
        _, codes = np.unique(joined, return_inverse=True)
        rank, span = codes.reshape(table.shape).astype(np.uint64) + _U(1), span + step
        rank[~inside] = 0
    whole = np.arange(width) + run <= sizes[:, None]
    owner, offset = np.nonzero(whole)
    order = np.argsort(rank[owner, offset], kind="stable")  # the array's rows
    keys = rank[owner, offset][order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    least, most = np.minimum.reduceat(low[owner[order]], start), np.maximum.reduceat(high[owner[order]], start)
    hit = np.zeros((len(contexts), width), bool)
    interval = np.cumsum(np.append(True, keys[1:] != keys[:-1])) - 1 if len(keys) else start
    hit[owner[order], offset[order]] = (least != most)[interval]
    return [hit[i, : n - run + 1] for i, n in enumerate(sizes)]


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []

    def work(rows: list[dict]) -> pa.RecordBatch:
        flags = repeated_runs(
            [np.array(r["tokens"], np.int64) for r in rows], np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([r["host"] for r in rows], pa.string()), pa.array([r["a"] for r in rows], pa.int64()),
             pa.array([r["c"] for r in rows], pa.int64()), pa.array([np.flatnonzero(f) for f in flags], pa.list_(pa.int64()))],
            names=["host", "a", "c", "hits"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if len(held) >= CONTEXTS and (row["host"], row["a"]) != (held[-1]["host"], held[-1]["a"]):
                yield work(held)
                held = []
            held.append(row)
    if held:
        yield work(held)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for blocks, found in zip(batch.column("blocks").to_pylist(), batch.column("found").to_pylist(), strict=True):
            cover: dict[int, set[int]] = {}
            for hit in found or ():
                cover.setdefault(hit["block"], set()).update(range(hit["at"], hit["at"] + RUN))
            out = []
            for i, text in enumerate(blocks or ()):
                if i in cover:
                    text = " ".join(w for j, w in enumerate(text.split(" ")) if j not in cover[i])
                if text:
                    out.append(text)
            texts.append("\n\n".join(out))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def _articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the pages with an article, without the blocks of their host's template."""
    for batch in batches:
        for first in range(0, batch.num_rows, PAGES):
            part = batch.slice(first, PAGES)
            rows, texts = [], []
            for i, (html, template) in enumerate(zip(part.column("html").to_pylist(), part.column("template").to_pylist(), strict=True)):
                blocks, sure = blocks_of(html)
                if sure:
                    out = set(template or ())
                    rows.append(i)
                    texts.append("\n\n".join(b for b in blocks if not out or _key(b) not in out))
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array(rows, pa.int64())), pa.array(texts, pa.string())], names=["row", "text"]
            )


def _marks(contexts: DataFrame) -> DataFrame:
    """The windows of every context that occur on two distinct pages: ``hits``, places in the context."""
    distinct = contexts.groupBy("host", "a", "c").agg(
        F.min("body").alias("low"), F.max("body").alias("high"), F.first("tokens").alias("tokens")
    )
    marks = distinct.repartition("host", "a").sortWithinPartitions("host", "a").mapInArrow(
        _marked, "host string, a bigint, c bigint, hits array<bigint>"
    )
    return marks.where("size(hits) > 0")


def templates(rows: DataFrame, survey: DataFrame) -> DataFrame:
    """``host`` and ``template``: hashes of the blocks that the host's suffix array finds in its template."""
    sure = survey.where("sure")
    hosts = sure.groupBy("host").agg(F.count_distinct("body").alias("bodies")).where(F.col("bodies") >= TEMPLATE_PAGES)
    # Hosts go as hashes where every anchor crosses the network. Copies count here, so this keeps
    # too many anchors, never too few.
    enough = hosts.select(F.xxhash64("host").alias("site"), "host", "bodies")
    counted = sure.select(F.xxhash64("host").alias("site"), F.explode("anchors").alias("a")).groupBy("site", "a").agg(F.count("*").alias("k"))
    often = counted.join(broadcast_if_small(enough), "site").where("2 * k > bodies").select("host", "a")
    often = stage(often, "anchors")
    schema = "host string, body bigint, block bigint, size int, a bigint, c bigint, s int, tokens array<bigint>"
    every = rows.select("host", "html").mapInArrow(_article_contexts, schema)
    contexts = stage(every.join(broadcast_if_small(often), ["host", "a"]), "contexts")
    hits = contexts.join(_marks(contexts), ["host", "a", "c"])
    hits = hits.select("host", "body", "block", "size", "s", "tokens", F.explode("hits").alias("at")).select(
        "host", "body", "block", "size", (F.col("s") + F.col("at")).alias("at"), F.xxhash64(F.slice("tokens", F.col("at").cast("int") + 1, RUN)).alias("w")
    )
    shared = hits.groupBy("host", "w").agg(F.count_distinct("body").alias("k")).join(hosts, "host").where("2 * k > bodies")
    places = hits.join(shared.select("host", "w"), ["host", "w"]).groupBy("host", "block", "size").agg(F.array_sort(F.collect_set("at")).alias("at"))
    reach = F.aggregate("at", F.lit(0).cast("bigint"), lambda end, at: F.when(at <= end, F.greatest(end, at + RUN)).otherwise(end))
    found = stage(places.where(reach >= F.col("size")).groupBy("host").agg(F.collect_set("block").alias("template")), "templates")
    discard(often, contexts)
    return found


def main_text(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """``row`` (columns ``keep``, else all) and ``text``, one row per page."""
    rows = pages.select(
        F.struct(*[F.col(c) for c in keep or pages.columns]).alias("row"),
        F.coalesce(F.col(id).cast("bigint"), F.lit(-1)).alias("page"),
        F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.col(html).cast("string").alias("html"),
    )
    row = rows.schema["row"].dataType.simpleString()
    schema = f"row {row}, page bigint, host string, blocks array<string>, sure boolean, body bigint, anchors array<bigint>"
    survey = stage(rows.mapInArrow(_surveyed, schema), "survey")
    known = rows.select("row", "host", "html").join(broadcast_if_small(templates(rows, survey)), "host", "left")
    sure = known.select("row", "html", "template").mapInArrow(_articles, f"row {row}, text string")
    rest = survey.where("NOT sure").select("row", "page", "host", "blocks")
    # Rows with equal page ids are one page, with one body.
    bodies = rest.groupBy("page").agg(F.min(F.xxhash64("blocks")).alias("body"))
    open_blocks = rest.join(bodies, "page").select("host", "page", "body", F.posexplode("blocks").alias("block", "text"))
    schema = "host string, page bigint, body bigint, block int, a bigint, c bigint, s int, tokens array<bigint>"
    contexts = open_blocks.mapInArrow(_contexts, schema)
    hits = contexts.select("host", "a", "c", "page", "block", "s").join(_marks(contexts), ["host", "a", "c"])
    hits = hits.select("page", "block", F.explode("hits").alias("at"), "s").select(
        "page", F.struct("block", (F.col("s") + F.col("at")).alias("at")).alias("hit")
    )
    per_page = hits.groupBy("page").agg(F.collect_set("hit").alias("found"))
    rest = rest.join(per_page, "page", "left").select("row", "blocks", "found")
    return sure.union(rest.mapInArrow(_kept, f"row {row}, text string"))
