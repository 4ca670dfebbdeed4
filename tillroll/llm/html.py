"""Main text of web pages by the maximum-scoring contiguous run of tokens.

A page becomes a run of tokens in page order: words and tags.  Tags score negative, words
positive or negative, with weights learned from labelled pages: pages whose main part is marked
up (one ``article``, else one ``main``).  Two kinds of counts are learned over all such pages:
how often a tag stands inside the marked part, and how often the words below a *context* (the
nearest enclosing element that has a meaning: a sectioning tag, or a tag with class, id or
role) do.  A word's score is the log odds of its context, so that words in contexts of menus,
adverts or footers count against a region.  One linear scan (``best_run``) finds the run with
the greatest sum.  The text is that of the run's blocks, without blocks of a negative context
(an advert between two paragraphs).  The marks of the page itself are not looked at: a page is
read the same with its ``article`` tags taken out.

Names (``STRONG``, ``WEAK``) are a prior only.  A strong name counts as ``PRIOR_WORDS`` words
seen outside, so labelled words overrule it; without labels its text is left out.  A weak name
without labels is believed for elements of fewer than ``WEAK_WORDS`` words: a longer text is
text whatever its container is called.  Elements that HTML sets apart (``NEVER``: navigation,
footers, headers, asides, forms, scripts) are never text.  Contexts that no labelled page has
fall back on these priors, else on the enclosing context.  The learned table keeps contexts and
tags seen on ``MIN_PAGES`` pages.  The ``MAX_KEYS`` most frequent of them are broadcast; the
others, if any, are joined to the pages that have them, by key.

Cases: a null page is empty; a page without a positive run gives empty text; malformed markup
(unclosed or stray tags) is read as browsers do for the common cases; pages of any length are
read whole; of runs with equal sums the first, and of those from one start the shortest, is
taken; repeated rows are extracted each; other columns pass through whatever their names,
``text`` and ``n_chars`` are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import ChainMap, Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, stored

MIN_PAGES = 2
MAX_KEYS = 50_000

# fixed values of the HTML standard: elements without content, with raw text, and blocks
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
# an opening tag of the key ends an open element of these, up to the nearest of the limits
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
_ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "body", "head", "html"}
SECTIONS = frozenset("article main nav header footer aside form section search dialog menu".split())
# elements whose text is never main text
NEVER = frozenset(
    "head nav footer aside form dialog menu search select button textarea script style "
    "template noscript iframe object svg math audio video canvas header label title".split()
)
# names that a prior holds against: the head of a (hyphenated) name counts, as in "site-nav"
# or "share-buttons"; "share-of-voice" and "menu-planning" are other things
PRIOR_WORDS = 30
WEAK_WORDS = 15
_PARTS = (
    r"(?:[-_](?:buttons?|links?|lists?|items?|bars?|box|slots?|container|wrapper|wrap|blocks?|section|"
    r"area|inner|unit|label|top|bottom|left|right|\d+))*"
)
_HEAD = r"(?:^|[-_ .])(?:{})" + _PARTS + r"(?:$|[ .])"
STRONG = re.compile(_HEAD.format(
    r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|breadcrumbs?|pagination|"
    r"pager|related|recommend\w*|newsletter|subscribe|sign-?up|login|comments?|disqus|replies|"
    r"side-?bar|nav|navigation|navbar|skip|copyright"
))
WEAK = re.compile(_HEAD.format(
    r"banner|notices?|overlay|menu|header|masthead|footer|foot|aside|widgets?|share|sharing|social|"
    r"search|form|responses?|reply|toolbar|legal|disclaimer|tags?|hidden"
))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SPACE = re.compile(r"\s+")


@dataclass
class Context:
    """An open element."""

    tag: str
    keys: tuple[str, ...]  # names of its meaning, most exact first; empty: its parent's
    parent: Context | None
    never: bool
    cover: int  # number of the marked region's element (article or main) around it


@dataclass
class Block:
    """A run of text that no block tag interrupts."""

    context: Context
    at: int  # position among the tokens
    parts: list[str] = field(default_factory=list)

    def text(self) -> str:
        return _SPACE.sub(" ", unescape("".join(self.parts))).strip()


def _keys(tag: str, attributes: str) -> tuple[str, ...]:
    named = {}
    if "=" in attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id", "role"):
                named[name.lower()] = (a or b or c).lower().strip()
    names = sorted({x for v in named.values() for x in v.split()})
    if names:
        return (f"{tag}.{'.'.join(names)}", *(f"{tag}.{x}" for x in names))
    return (tag,) if tag in SECTIONS else ()


def parse(html: str) -> tuple[list[Block], list[tuple[str, int, Context]]]:
    """(blocks, tags as (key, position, context)) of a page, in page order."""
    root = Context("", (), None, False, 0)
    stack, blocks, tags = [root], [], []
    at, covers = 0, 0
    block: Block | None = None
    opened: Counter = Counter()

    def close(depth: int) -> None:
        opened.subtract(c.tag for c in stack[depth:])
        del stack[depth:]

    def text(piece: str) -> None:
        nonlocal block, at
        if not piece:
            return
        context = stack[-1]
        if block is None or _home(block.context) is not _home(context):
            block = Block(context, at)
            blocks.append(block)
            at += 1
        block.parts.append(piece)

    pos, end = 0, len(html)
    while pos < end:
        m = _TOKEN.search(html, pos)
        if m is None:
            text(html[pos:])
            break
        text(html[pos : m.start()])
        pos = m.end()
        if m[2] is None:
            continue  # comment, declaration
        tag, closing = m[2].lower(), bool(m[1])
        if tag in BLOCK:
            block = None
        elif tag == "br":
            text(" ")
        if closing:
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[depth].tag == tag:
                    tags.append((f"/{(stack[depth].keys or (tag,))[0]}", at, stack[depth]))
                    close(depth)
                    break
                if stack[depth].tag in SECTIONS and tag not in BLOCK:
                    break  # a stray inline end tag closes no section
            at += 1
            continue
        ends, limits = _ENDS.get(tag, ((), ()))
        if any(opened[x] > 0 for x in ends):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in limits:
                    break
                if stack[depth].tag in ends:
                    close(depth)
                    break
        if tag in _ENDS_P and opened["p"] > 0:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in BLOCK:
                    break
        keys = _keys(tag, m[3])
        parent = stack[-1]
        cover = parent.cover
        if tag in ("article", "main") and not cover:
            covers += 1
            cover = covers
        context = Context(tag, keys, parent, parent.never or tag in NEVER, cover)
        tags.append(((keys or (tag,))[0], at, context))
        at += 1
        if tag in RAW:
            m = re.compile(rf"</{tag}\s*>", re.I).search(html, pos)
            pos = m.end() if m else end
        elif tag not in VOID and (tag in BLOCK or not m[3].endswith("/")):
            stack.append(context)  # HTML has no self-closing blocks
            opened[tag] += 1
    return [b for b in blocks if any(p.strip() for p in b.parts)], tags


def _home(context: Context) -> Context:
    """The nearest element with a meaning."""
    while not context.keys and context.parent is not None and context.tag not in NEVER:
        context = context.parent
    return context


def _marked(tags: list[tuple[str, int, Context]]) -> int:
    """The number of the page's one marked part (article, else main), or 0."""
    found: dict[str, set[int]] = {}
    for key, _, context in tags:
        if context.tag in ("article", "main") and context.cover:
            found.setdefault(context.tag, set()).add(context.cover)
    covers = found.get("article") or found.get("main") or set()
    return covers.pop() if len(covers) == 1 else 0


def label_counts(html: str) -> Counter:
    """(kind, key, inside) -> words or tags, for a page with one marked part; else empty."""
    blocks, tags = parse(html)
    cover = _marked(tags)
    if not cover:
        return Counter()
    out = Counter()
    for b in blocks:
        home = _home(b.context)
        inside = b.context.cover == cover and not b.context.never
        words = len(b.text().split())
        for key in home.keys:
            out["word", key, inside] += words
    for key, _, context in tags:
        if context.never:
            continue  # what HTML sets apart says nothing about a tag elsewhere
        outer = context.parent if context.cover == cover and context.tag in ("article", "main") else context
        out["tag", key, bool(outer and outer.cover == cover)] += 1
    return out


def _named(keys: tuple[str, ...], names: re.Pattern) -> bool:
    """Whether one of an element's names is among ``names``."""
    return any(names.search(k.split(".", 1)[1]) for k in keys if "." in k)


def best_run(scores: list[float]) -> tuple[int, int]:
    """(start, end) of the contiguous run with the greatest sum, in one scan; (0, 0) if no run
    is positive.  Of equal sums the one that ends first."""
    best, run, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, run = total, (start, i + 1)
    return run


@dataclass
class Model:
    words: Mapping[str, float]  # log odds of a context's words
    tags: Mapping[str, float]  # scores of tags, all negative
    default_word: float = 2.0
    default_tag: float = -0.4
    rare: DataFrame | None = None  # (kind, key, out, inside) of the learned keys not in these

    def with_counts(self, counts: dict[tuple[str, str], tuple[int, int]]) -> Model:
        """This model and what further counts say."""
        more = model_from_counts(counts)
        return replace(self, words=ChainMap(more.words, self.words), tags=ChainMap(more.tags, self.tags))

    def unknown(self, html: str) -> set[tuple[str, str]]:
        """(kind, key) of all that the page would look up and that is not in this model."""
        _, tags = parse(html)
        keys = {("tag", key) for key, _, _ in tags if key not in self.tags}
        return keys | {("word", k) for _, _, c in tags for k in c.keys if k not in self.words}

    def context_score(
        self, context: Context | None, memo: dict[int, float], words: dict[int, int]
    ) -> float:
        """Score of a word below ``context``: what was learned for its keys, else what its
        names say, else its parent's.  ``words``: how many stand in an element."""
        chain = []
        while context is not None and id(context) not in memo:
            chain.append(context)
            context = context.parent
        score = self.default_word if context is None else memo[id(context)]
        for context in reversed(chain):
            above, keys = score, context.keys
            learned = [self.words[k] for k in keys if k in self.words]
            part = context.tag in ("article", "main")
            if context.never:
                score = -3.0
            elif above < 0 and not part:
                score = above  # what stands in something else than text stays so
            elif learned:
                # the whole name if that is known, else its most telling part
                score = learned[0] if keys[0] in self.words else max(learned, key=abs)
            elif _named(keys, STRONG) or (
                _named(keys, WEAK) and words.get(id(context), 0) < WEAK_WORDS
            ):
                score = -3.0
            elif above < 0:
                score = self.default_word
            memo[id(context)] = score
        return score

    def extract(self, html: str | None) -> str:
        if not html:
            return ""
        blocks, tags = parse(html)
        texts = [b.text() for b in blocks]
        sizes = [len(t.split()) for t in texts]
        words: dict[int, int] = {}
        for b, n in zip(blocks, sizes):
            context = b.context
            while context is not None:
                if context.keys:
                    words[id(context)] = words.get(id(context), 0) + n
                context = context.parent
        memo: dict[int, float] = {}
        tokens: list[tuple[int, float, str | None]] = []
        for b, text, n in zip(blocks, texts, sizes):
            score = self.context_score(b.context, memo, words)
            # a text goes on behind an advert, however many words that has
            tokens.append((b.at, score * n if score > 0 else -1.0, text))
        tokens += [(at, self.tags.get(key, self.default_tag), None) for key, at, _ in tags]
        tokens.sort(key=lambda t: t[0])
        run = tokens[slice(*best_run([score for _, score, _ in tokens]))]
        return "\n".join(text for _, score, text in run if text and score > 0)


def model_from_counts(counts: dict[tuple[str, str], tuple[int, int]]) -> Model:
    """``counts``: (kind, key) -> (outside, inside)."""
    words, tags = {}, {}
    for (kind, key), (out, inside) in counts.items():
        if kind == "word" and "." in key:
            name = (key,)
            out += PRIOR_WORDS if _named(name, STRONG) else PRIOR_WORDS // 3 if _named(name, WEAK) else 0
        odds = log((inside + 0.5) / (out + 0.5))
        if kind == "word":
            words[key] = max(-3.0, min(3.0, odds))
        else:  # a tag never adds to a region; outside tags cost more
            tags[key] = -max(0.1, min(3.0, 0.1 - odds))
    return Model(words, tags)


def fit(pages: DataFrame, html_col: str = "html") -> Model:
    """Count contexts and tags over all labelled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = Counter(), Counter()
        def flush():
            rows = [(kind, key, inside, v, n[kind, key]) for (kind, key, inside), v in total.items()]
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
            names = ["kind", "key", "inside", "v", "pages"]
            total.clear(), n.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        for batch in batches:
            for html in batch.column(0):
                page = label_counts(html.as_py() or "")
                total.update(page)
                n.update({(kind, key) for kind, key, _ in page})
                if len(total) > 4 * MAX_KEYS:
                    yield flush()
        yield flush()

    partial = map_arrow(
        pages.select(F.col(f"`{html_col}`").cast("string")), run,
        "kind string, key string, inside boolean, v long, pages long",
    )
    kept = stored(
        partial.groupBy("kind", "key")
        .agg(
            F.sum(F.when(F.col("inside"), F.lit(0)).otherwise(F.col("v"))).alias("out"),
            F.sum(F.when(F.col("inside"), F.col("v")).otherwise(F.lit(0))).alias("inside"),
            F.sum("pages").alias("pages"),
        )
        .where(F.col("pages") >= MIN_PAGES),
        "keys",
    )
    order = F.struct((-F.col("pages")).alias("p"), "kind", "key")
    top = kept.orderBy(order).limit(MAX_KEYS + 1).collect()
    model = model_from_counts({(r.kind, r.key): (r.out, r.inside) for r in top[:MAX_KEYS]})
    if len(top) > MAX_KEYS:
        first = top[MAX_KEYS]
        beyond = F.struct(F.lit(-first.pages).cast("long").alias("p"), F.lit(first.kind).alias("kind"),
                          F.lit(first.key).alias("key"))
        model.rare = kept.where(order >= beyond).select("kind", "key", "out", "inside")
    return model


def _with_rare(rows: DataFrame, model: Model, shared) -> DataFrame:
    """``rows`` and ``_found``: the rare keys that the page has, with their counts.  Pages
    with equal html share them.  A frequent key is in the broadcast model and no join key."""
    rows = rows.withColumn("_page", F.sha2(F.col("_html").cast("binary"), 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = {
                    (page, *key) for page, html in zip(*(c.to_pylist() for c in part.columns))
                    for key in shared.value.unknown(html)
                }
                columns = list(zip(*found)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns], ["_page", "kind", "key"]
                )

    keys = map_arrow(
        rows.where("_html IS NOT NULL").select("_page", "_html"), run, "_page string, kind string, key string"
    )
    found = (
        keys.distinct().join(model.rare, ["kind", "key"]).groupBy("_page")
        .agg(F.collect_list(F.struct("kind", "key", "out", "inside")).alias("_found"))
    )
    return rows.join(found, "_page", "left").drop("_page")


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``pages`` without the html plus ``text`` and ``n_chars`` (code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(replace(model, rare=None))
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    others = [f"c{i}" for i in range(len(keep))]
    rows = pages.select(
        *(F.col(f"`{c}`").alias(o) for c, o in zip(keep, others)),
        F.col(f"`{html_col}`").cast("string").alias("_html"),
    )
    rare = model.rare is not None
    if rare:
        rows = _with_rare(rows, model, shared).select(*others, "_found", "_html")

    def text(html: str | None, found: list[dict] | None) -> str:
        model = shared.value
        if found:
            model = model.with_counts({(f["kind"], f["key"]): (f["out"], f["inside"]) for f in found})
        return model.extract(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(batch.num_columns - 1)
            for at in range(0, batch.num_rows, 256):
                found = batch.column(len(keep)).slice(at, 256) if rare else None
                texts = [
                    text(h.as_py(), found[i].as_py() if rare else None)
                    for i, h in enumerate(html.slice(at, 256))
                ]
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(at, 256) for c in batch.columns[: len(keep)]), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ], [*others, "text", "n_chars"])

    fields = [f"{o} {pages.schema[c].dataType.simpleString()}" for c, o in zip(keep, others)]
    found = map_arrow(rows, run, ", ".join([*fields, "text string", "n_chars long"]))
    return found.toDF(*keep, "text", "n_chars")
