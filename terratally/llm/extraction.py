"""Main text of web pages by a tree-structured graphical model over the DOM.

Block elements and the text blocks in them are nodes with a hidden label, content or not. Features
give each node evidence, parent-child potentials couple neighbours, and sum-product messages, once
upwards and once downwards, give exact marginals, as the graph is a tree. Evidence and potentials
are counted from labelled pages on top of prior counts.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that training reads at most, those with the smallest hashes; the model is of fixed size.
TRAINING_PAGES = 4_000
#: Features of the model at most, the most frequent ones of the training pages.
MODEL_FEATURES = 1_000
#: Weight of the labelled counts against the prior ones, and the bound of one feature's evidence.
PRIOR_WEIGHT = 20.0
CLIP = 3.0
#: A copyright line has fewer words.
LEGAL_WORDS = 25

# Elements by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SKIPPED = frozenset(
    "script style noscript template head title textarea select svg math iframe object canvas audio "
    "video datalist button".split()
)
BOILERPLATE = frozenset("nav footer header aside form menu dialog fieldset".split())
MAIN = frozenset(("article", "main"))
_RAW = frozenset("script style textarea title noscript iframe".split())
#: What may stand in a head; any other tag begins the body.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_IMPLIED = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
_SCOPE = frozenset("ul ol dl table body html div article section td th".split())
_BAD_NAME = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adv|banner|breadcrumbs?|byline|comments?|consent|cookies?|"
    r"copyright|disclaimer|disqus|footer|footnav|gdpr|header|login|masthead|menu|meta|modal|"
    r"nav|navbar|navigation|newsletter|notices?|notification|pager|pagination|paywall|popup|promo\w*|"
    r"recommend\w*|related|repl(?:y|ies)|search|share|sharing|shop|sidebar|sidenav|signup|skip|"
    r"social|sponsor\w*|subscribe|subscription|tags?|toolbar|topbar|widget)(?:$|[^a-z])"
)
_GOOD_NAME = re.compile(
    r"(?:^|[^a-z])(?:article\w*|body|content|entry|hentry|main|post|story|text)(?:$|[^a-z])"
)
#: Names of a wrapper that tell what stands beside its content.
_BESIDE = re.compile(r"(?:^|[-_])(?:with|has|no|without|is)[-_].*")
_LEGAL = re.compile(r"©|\(c\) |copyright\b|all rights reserved", re.I)
_BAD_ROLE = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert dialog".split()
)
_TAG = re.compile(
    r"<!--.*?(?P<close>-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_BLOCK = re.compile(
    r"</?(?:html|head|body|article|aside|div|footer|form|h[1-6]|header|main|nav|ol|p|section|table|ul)(?=[\s/>])", re.I
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


class Page:
    """Block elements and text blocks in page order: parent's number, features, and text if any."""

    __slots__ = ("parents", "features", "texts", "names")

    def __init__(self) -> None:
        self.parents: list[int] = [-1]
        self.features: list[tuple[str, ...]] = [("tag=root",)]
        self.texts: list[str | None] = [None]
        self.names: list[tuple[str, str]] = [("root", "")]

    def add(self, parent: int, name: str, cue: str, features: tuple[str, ...], text: str | None) -> int:
        self.parents.append(parent)
        self.features.append(features)
        self.texts.append(text)
        self.names.append((name, cue))
        return len(self.parents) - 1

    def closed(self) -> list[bool]:
        """Boilerplate that its author marked, with all in it, and legal lines outside an article.

        Their label is observed, and as what stands in a page's main part may well hold such
        blocks, they say nothing about their parents.
        """
        closed = [False] * len(self.parents)
        article = [False] * len(self.parents)
        for i in range(1, len(closed)):
            (name, cue), parent = self.names[i], self.parents[i]
            article[i] = article[parent] or name in MAIN
            legal = cue == "legal" and not article[i]
            closed[i] = closed[parent] or name in BOILERPLATE or cue == "bad" or legal
        return closed


def _cue(name: str, rest: str) -> str:
    """What the names an author gave say: ``bad`` for boilerplate, ``good`` for the main part."""
    if not rest or name in ("html", "body"):
        return ""
    good = bad = False
    for attribute, value in _ATTRIBUTE.findall(rest):
        value = value.strip("\"' ").lower()
        attribute = attribute.lower()
        if attribute in ("hidden", "aria-hidden"):
            bad = bad or attribute == "hidden" or value == "true"
        elif attribute == "role":
            bad = bad or value in _BAD_ROLE
            good = good or value in ("main", "article")
        else:
            for word in value.split():
                if _BAD_NAME.search(_BESIDE.sub("", word)):
                    bad = True
                elif _GOOD_NAME.search(word):
                    good = True
    return "" if good == bad else "good" if good else "bad"


def _bucket(value: int, *bounds: int) -> int:
    return sum(value >= bound for bound in bounds)


def parse(source: str) -> Page:
    """Tolerant of missing end tags; the content of scripts, styles and the like is left out.

    A ``<`` without any ``>`` after it is text. A page takes time in proportion to its length: no
    search for an end runs twice where there is none.
    """
    page = Page()
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements with the node of their block
    opened: Counter = Counter()  # their names
    pieces: list[str] = []
    linked = links = 0  # characters in links, links open

    def flush() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                share = min(1.0, linked / max(1, len(raw)))
                features = (
                    f"words={_bucket(text.count(' ') + 1, 4, 10, 25)}",
                    f"links={_bucket(int(share * 10), 1, 4, 8)}",
                    f"stop={text[-1] in '.!?:;”»…'}",
                )
                legal = "legal" if _LEGAL.match(text) and text.count(" ") < LEGAL_WORDS else ""
                page.add(stack[-1][1], "#text", legal, features, text)
            pieces.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal links
        while len(stack) > to:
            name, _ = stack.pop()
            links -= name == "a"
            opened[name] -= 1

    def raw_end(name: str, at: int) -> int:
        """Where the content of a raw element ends; without an end tag, at the next block's tag."""
        if name not in endless:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            if end:
                return end.end()
            endless.add(name)
        if name in ("script", "style"):
            return size
        block = _BLOCK.search(source, at)
        return block.start() if block else size

    at, size = 0, len(source)
    last = source.rfind(">") + 1  # no tag ends beyond
    endless: set[str] = set()  # raw elements without an end tag further on
    skipping = ""
    depth = 0
    inner: Counter = Counter()  # elements opened in the skipped one
    while at < size:
        match = _TAG.search(source, at, last) if at < last else None
        if match is None:
            if not skipping:
                pieces.append(source[at:].partition("<!--")[0])
            break
        if not skipping and match.start() > at:
            piece = source[at : match.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = match.end()
        name = match["name"] or match["name2"]
        if name is None:
            if match["close"] == "":
                break  # the comment never ends
            continue
        name = name.lower()
        ends = bool(match["end"] or match["end2"])
        rest = match["rest"] or match["rest2"] or ""
        if skipping:
            if name == skipping and not rest.endswith("/"):
                depth += -1 if ends else 1
                if not depth:
                    skipping = ""
                continue
            if skipping == "head":
                if name in _IN_HEAD:
                    if name in _RAW and not ends:
                        at = raw_end(name, at)
                    if not (ends and name == "html"):
                        continue
            elif not ends or name in INLINE or not opened[name] or name in inner:
                # An end tag of what was opened inside is no end of what is around.
                if name not in VOID and not rest.endswith("/"):
                    inner[name] += -1 if ends else 1
                    if inner[name] <= 0:
                        del inner[name]
                continue
            skipping = ""
        if name in SKIPPED:
            if ends or rest.endswith("/") and name in ("svg", "math"):
                continue
            if name in ("head", "title"):  # the others stand within a line
                flush()
            if name in _RAW:
                at = raw_end(name, at)
            else:
                skipping, depth, inner = name, 1, Counter()
            continue
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                if ends:
                    links = max(0, links - 1)
                else:
                    links += 1
            continue
        flush()
        links = 0
        if ends:
            for i in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[i][0] == name:
                    close(i)
                    break
            continue
        if name in VOID:
            continue
        if name in _CLOSES_P and stack[-1][0] == "p":
            close(len(stack) - 1)
        if closed := _IMPLIED.get(name):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closed:
                    close(i)
                    if name != "tr":
                        break
                elif stack[i][0] in _SCOPE and stack[i][0] not in closed:
                    break
        cue = _cue(name, rest)
        features = (f"tag={name}", f"cue={cue}") if cue else (f"tag={name}",)
        stack.append((name, page.add(stack[-1][1], name, cue, features, None)))
        opened[name] += 1
    flush()
    return page


def labels(page: Page) -> list[int] | None:
    """Known labels where the page says itself which part is its article, else None.

    What is in ``article`` or ``main`` is content, but for boilerplate elements and bad names in it.
    """
    label = [0] * len(page.parents)
    marked = False
    for i, (name, cue) in enumerate(page.names):
        if i:
            inside = label[page.parents[i]]
            label[i] = int((inside or name in MAIN) and name not in BOILERPLATE and cue != "bad")
            marked = marked or name in MAIN
    return label if marked else None


def _prior() -> Counter:
    """Counts that stand for general knowledge of pages; labelled ones are added to them."""
    counts: Counter = Counter()

    def say(feature: str, content: float, other: float) -> None:
        counts[feature, 1] += content * PRIOR_WEIGHT
        counts[feature, 0] += other * PRIOR_WEIGHT

    for name in MAIN:
        say(f"tag={name}", 30, 0.2)
    for name in BOILERPLATE:
        say(f"tag={name}", 0.05, 30)
    say("cue=bad", 0.05, 30)
    say("cue=good", 20, 2)
    for bucket, content, other in ((0, 2, 6), (1, 3, 4), (2, 5, 3), (3, 9, 1)):
        say(f"words={bucket}", content, other)
    for bucket, content, other in ((0, 10, 6), (1, 4, 2), (2, 1, 3), (3, 0.5, 12)):
        say(f"links={bucket}", content, other)
    say("stop=True", 8, 3)
    say("stop=False", 4, 7)
    say("tag=root", 1, 1)
    say("tag=html", 1, 1)
    say("tag=p", 4, 1)
    for name in ("h1", "h2", "h3", "h4", "blockquote", "pre", "figure", "table"):
        say(f"tag={name}", 3, 1)
    for name in ("div", "section", "ul", "ol", "li", "td", "tr", "body"):
        say(f"tag={name}", 2, 3)
    for a, b, weight in ((1, 1, 60), (1, 0, 1), (0, 0, 30), (0, 1, 2)):
        counts[f"from={a}", b] += weight * PRIOR_WEIGHT
    return counts


def count(page: Page) -> Counter:
    """Feature and parent-child counts of one labelled page; none if it has no labels."""
    counts: Counter = Counter()
    label = labels(page)
    if label is not None:
        closed = page.closed()
        for i in range(1, len(label)):
            if closed[i]:  # settled already, so it teaches nothing
                continue
            for feature in page.features[i]:
                counts[feature, label[i]] += 1
            counts[f"from={label[page.parents[i]]}", label[i]] += 1
    return counts


class Model:
    """Log odds of each feature, and the log of the parent-child potentials."""

    def __init__(self, counts: Counter):
        total = _prior()
        # Labelled pages weigh as much as the prior at most: they may all come from one template.
        edges = lambda found: sum(n for (f, _), n in found.items() if f.startswith("from="))
        scale = min(1.0, edges(total) / max(1.0, edges(counts)))
        for key, n in counts.items():
            total[key] += n * scale
        kinds = {"tag": [0.0, 0.0], "cue": [0.0, 0.0], "words": [0.0, 0.0], "links": [0.0, 0.0], "stop": [0.0, 0.0]}
        for (feature, label), n in total.items():
            kind = feature.partition("=")[0]
            if kind in kinds:
                kinds[kind][label] += n
        self.odds: dict[str, float] = {}
        for feature in {f for f, _ in total if not f.startswith("from=")}:
            all_of = kinds[feature.partition("=")[0]]
            one = (total[feature, 1] + 1) / (all_of[1] + 2)
            none = (total[feature, 0] + 1) / (all_of[0] + 2)
            self.odds[feature] = max(-CLIP, min(CLIP, log(one / none)))
        self.potential = {}
        for a in (0, 1):
            row = [total[f"from={a}", b] for b in (0, 1)]
            for b in (0, 1):
                self.potential[a, b] = log(row[b] / sum(row))

    def marginals(self, page: Page) -> list[float]:
        """Log odds of content of each node, by messages to the root and back."""
        odds = self.odds
        belief = [sum(odds.get(f, 0.0) for f in features) for features in page.features]
        parents = page.parents
        n = len(parents)
        p00, p01, p10, p11 = (self.potential[a, b] for a in (0, 1) for b in (0, 1))
        closed = page.closed()
        sent = [0.0] * n
        for i in range(n - 1, 0, -1):  # a parent stands before its children
            if closed[i]:
                continue
            x = belief[i]
            sent[i] = _sum(p10, p11 + x) - _sum(p00, p01 + x)
            belief[parents[i]] += sent[i]
        for i in range(1, n):
            if closed[i]:
                belief[i] = -_SURE
            else:
                x = belief[parents[i]] - sent[i]
                belief[i] += _sum(p01, p11 + x) - _sum(p00, p10 + x)
        return belief


_SURE = 100.0


def _sum(a: float, b: float) -> float:
    """Log of the sum of two exponentials."""
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


def main_text(source: str, model: Model) -> str:
    page = parse(source)
    odds = model.marginals(page)
    return "\n".join(t for t, x in zip(page.texts, odds, strict=True) if t is not None and x > 0)


def train(pages: DataFrame, html: str = "html", training_pages: int = TRAINING_PAGES) -> Model:
    """Count features of labelled pages, at most ``training_pages`` of them by hash of the html.

    The model keeps the ``MODEL_FEATURES`` most frequent of those that occur five times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for source in batch.column(0):
                total.update(count(parse(source.as_py())))
        features, label, n = zip(*((f, b, n) for (f, b), n in total.items()), strict=True) if total else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(features, pa.string()), pa.array(label, pa.int32()), pa.array(n, pa.int64())],
            ["feature", "label", "n"],
        )

    whole = F.coalesce(F.col(html), F.lit(""))
    digest = pages.select(F.xxhash64(whole).alias("h"))
    rows = digest.agg(F.count("*").alias("n")).first()["n"]
    # An even share of the hashes; about as many pages as asked for, whatever the table's order.
    share = min(1.0, training_pages / max(1, rows))
    bound = int(-(2**63) + share * (2**64 - 1))
    sample = pages.select(whole.alias("html")).where(F.xxhash64(whole) <= min(bound, 2**63 - 1))
    counts = sample.mapInArrow(run, "feature string, label int, n long")
    # Tags that hardly any page has say nothing; what comes back is one row per tag or feature.
    kept = counts.groupBy("feature", "label").agg(F.sum("n").alias("n")).where("n >= 5")
    rows = kept.orderBy(F.desc("n"), "feature", "label").limit(MODEL_FEATURES).collect()
    return Model(Counter({(r["feature"], r["label"]): r["n"] for r in rows}))


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id long, url string, text string, n_chars long`` for every row.

    A null or empty html gives an empty text. Repeated rows give repeated results, other columns
    are ignored, an empty table gives no rows.
    """
    model = model or train(pages)
    names = ["page_id", "url", "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py(), model) for source in batch.column(2)]
            counts = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], names
            )

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit(""))
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
