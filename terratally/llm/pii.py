"""Personal data by weak supervision, in DataFrame functions throughout.

Candidates are the matches of four strict patterns and every other word with a digit. Labelers
that look at shape, gazetteers, context and length vote on each; expectation-maximisation over the
table of vote patterns estimates how reliable a labeler is and what each pattern is worth; the
resulting soft labels train the span classifier, naive Bayes over hashed features. Both tables have
a fixed number of rows, however large the corpus.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.llm.common import fresh, let, staged

# The kinds in their order and their patterns. Possessive repeats and the look at
# where the last match ended change no match; they keep long texts linear.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Any other word with a digit may be personal data as well.
_WORD = r"(?<!\S)[^\s\d]*+\d\S*+"
_MARK = "﷐"

#: Results that are gathered in one array; even, as every second part of a cut text is a match.
_CHUNK = 256
#: Code points of the pieces that a text is cut into to be put together anew.
_PIECE = 2048

_CONTEXT = 24
_GOOD_CONTEXT = (
    r"(?i)(e-?mail|phone|tel|call|mobile|card|visa|ip|passw|pwd|token|secret|key|contact|account|"
    r"iban|ssn|passport|customer|user)"
)
_BAD_CONTEXT = r"(?i)(version|licen[cs]e|section|chapter|page|figure|fig|table|cc|by|no|nr|vol)[-. ]*\S*$"
# Endings of hosts, prefixes of keys, and words that only look private.
_GAZETTEER = (
    r"(?i)(@\S+\.(com|org|net|edu|gov|io|de|fr|es|uk|it|nl|eu|info)$)|^(AKIA|ASIA|ghp_|gho_|sk-|xox[bp]-)"
    r"|^\+(1|33|34|44|49)\b"
)
_COMMON = r"^((19|20)[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}|[0-9]{1,3}(st|nd|rd|th)|[0-9]{1,3}%?)$"
_SHAPE = r"^([0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|AKIA[0-9A-Z]{16})$"
_SECRET = r"(?=[A-Za-z0-9_]*[A-Za-z])(?=[A-Za-z_]*[0-9])[A-Za-z0-9_]{16,}"
LABELERS = 6
SHAPES = CONTEXTS = 4096
LENGTHS = 64
ROUNDS = 50

_SPAN = "struct<start:int,kind:int,end:int,value:string,context:string>"


def _scanned(items: Column, start: Column, step, emitted) -> Column:
    """What ``emitted(state, item)`` gives along ``items``, without nulls; ``step`` moves the state.

    An appended array is a copied array, so results gather in short arrays that are put together at
    the end: long texts take hardly longer than their parts would.
    """
    none = F.filter(F.array(let(start, lambda s: emitted(s, F.get(items, F.lit(0))))), lambda x: F.lit(False))

    def over_items(so_far: Column, item: Column) -> Column:
        def put(out: Column) -> Column:
            return F.struct(
                step(so_far["state"], item).alias("state"),
                F.when(out.isNull(), so_far["out"]).otherwise(F.array_append(so_far["out"], out)).alias("out"),
            )

        return let(emitted(so_far["state"], item), put)

    def over_chunks(so_far: Column, at: Column) -> Column:
        inner = F.aggregate(
            F.slice(items, at * _CHUNK + 1, F.lit(_CHUNK)),
            F.struct(so_far["state"].alias("state"), none.alias("out")),
            over_items,
        )
        return let(
            inner,
            lambda done: F.struct(
                done["state"].alias("state"), F.array_append(so_far["out"], done["out"]).alias("out")
            ),
        )

    chunks = F.sequence(F.lit(0), (F.size(items) / _CHUNK).cast("int"))
    empty = F.filter(F.array(none), lambda x: F.lit(False))
    begin = F.struct(start.alias("state"), empty.alias("out"))
    return F.aggregate(chunks, begin, over_chunks, lambda done: F.flatten(done["out"]))


def _found(text: Column, pattern: str, kind: int) -> Column:
    """All matches in order, with their places in code points and what stands before them.

    Matches are set between marks, and the text is cut at these: every second part is a match.
    """
    parts = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)

    def step(so_far: Column, part: Column) -> Column:
        return F.struct(
            (so_far["at"] + F.length(part)).alias("at"),
            (~so_far["inside"]).alias("inside"),
            F.when(so_far["inside"], so_far["before"]).otherwise(F.right(part, F.lit(_CONTEXT))).alias("before"),
        )

    def span(so_far: Column, part: Column) -> Column:
        found = F.struct(
            so_far["at"].alias("start"),
            F.lit(kind).alias("kind"),
            (so_far["at"] + F.length(part)).alias("end"),
            part.alias("value"),
            so_far["before"].alias("context"),
        )
        return F.when(so_far["inside"], found)

    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.lit("").alias("before"))
    return let(parts, lambda cut: _scanned(cut, start, step, span))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(digits: Column) -> Column:
        def worth(i: Column) -> Column:
            digit = F.substring(digits, i, F.lit(1)).cast("int")
            return F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

        places = F.sequence(F.lit(1), F.length(digits))
        return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b)

    return let(F.reverse(_digits(value)), total) % 10 == 0


def _checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda span: _valid(kind, span["value"]))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _base(text: Column) -> Column:
    """Spans of the four kinds by start, then kind."""
    none = F.array().cast(f"array<{_SPAN}>")
    lists = []
    for number, kind in enumerate(KINDS):
        spans = _checked(kind, _found(text, PATTERNS[kind], number))
        lists.append(F.when(text.contains("@"), spans).otherwise(none) if kind == "email" else spans)
    return F.sort_array(F.concat(*lists))


def _trimmed(span: Column) -> Column:
    """A word without the punctuation around it."""

    def cut(tail: Column) -> Column:
        value = F.regexp_replace(tail, "[.,;:!?)\\]}>\"']++$", "")
        start = span["start"] + F.length(span["value"]) - F.length(tail)
        return F.struct(
            start.alias("start"),
            span["kind"].alias("kind"),
            (start + F.length(value)).alias("end"),
            value.alias("value"),
            span["context"].alias("context"),
        )

    return let(F.regexp_replace(span["value"], "^[(\\[{<\"']++", ""), cut)


def _others(text: Column, base: Column) -> Column:
    """Further words with a digit, apart from the base spans.

    Words and base spans go by in the order of their starts. A word waits until it is known that no
    base span begins inside it; a last span behind the text lets the last word pass.
    """
    words = F.transform(_found(text, _WORD, len(KINDS)), _trimmed)
    far = F.lit(2**31 - 1)
    no_span = F.lit(None).cast(_SPAN)
    last = F.struct(
        far.alias("start"), F.lit(0).alias("kind"), far.alias("end"), F.lit("").alias("value"), F.lit("").alias("context")
    )

    def free(so_far: Column, span: Column) -> Column:
        return (span["kind"] == len(KINDS)) & (so_far["covered"] <= span["start"])

    def step(so_far: Column, span: Column) -> Column:
        is_base = span["kind"] < len(KINDS)
        hit = is_base & (span["start"] < so_far["waiting"]["end"])
        return F.struct(
            F.when(is_base, F.greatest(so_far["covered"], span["end"])).otherwise(so_far["covered"]).alias("covered"),
            F.when(free(so_far, span), span)
            .when(hit | (span["kind"] == len(KINDS)), no_span)
            .when(span["start"] >= so_far["waiting"]["end"], no_span)
            .otherwise(so_far["waiting"])
            .alias("waiting"),
        )

    def passed(so_far: Column, span: Column) -> Column:
        return F.when(so_far["waiting"]["end"] <= span["start"], so_far["waiting"])

    start = F.struct(F.lit(0).alias("covered"), no_span.alias("waiting"))
    in_order = F.sort_array(F.concat(base, words, F.array(last)))
    return let(in_order, lambda spans: _scanned(spans, start, step, passed))


def _votes(span: Column) -> list[Column]:
    """For (1), against (-1) or nothing (0), one column per labeler."""
    value, context = span["value"], span["context"]
    digits = F.length(_digits(value))

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    never = F.lit(False)
    return [
        vote((span["kind"] < len(KINDS)) | value.rlike(_SHAPE), value.rlike(_COMMON)),
        vote(value.rlike(_SECRET), never),
        vote(value.rlike(_GAZETTEER), value.rlike(_COMMON)),
        vote(value.rlike(_GOOD_CONTEXT) | context.rlike(_GOOD_CONTEXT), context.rlike(_BAD_CONTEXT)),
        vote(F.length(value) >= 10, F.length(value) <= 4),
        vote(digits >= 6, digits <= 2),
    ]


def _pattern(span: Column) -> Column:
    """The votes as one number in base three."""
    code = F.lit(0)
    for vote in _votes(span):
        code = code * 3 + vote + 1
    return code


def _features(span: Column) -> dict[str, Column]:
    value = span["value"]
    shape = value
    for letters, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "9")):
        shape = F.regexp_replace(shape, letters, sign)
    before = F.lower(F.regexp_extract(span["context"], r"(\S+)\s*$", 1))
    return {
        "shape": F.pmod(F.xxhash64(shape), F.lit(SHAPES)).cast("int"),
        "before": F.pmod(F.xxhash64(before), F.lit(CONTEXTS)).cast("int"),
        "length": F.least(F.length(value), F.lit(LENGTHS - 1)),
    }


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and its spans: ``base``, and ``all`` with votes and features. Null text is empty."""
    none = F.array().cast(f"array<{_SPAN}>")
    whole = F.coalesce(F.col(text), F.lit(""))
    clean = F.when(whole.contains(_MARK), F.translate(whole, _MARK, "�")).otherwise(whole)
    # Most texts have no digit at all and no address; the patterns are not tried on these.
    likely = whole.rlike("[0-9@]")
    base = F.when(likely, let(clean, _base)).otherwise(none)
    rows = docs.select(F.col(key).alias("doc_id"), clean.alias("clean"), base.alias("base"))
    others = F.when(
        rows["clean"].rlike("[0-9]"), let(F.col("clean"), lambda t: _others(t, F.col("base")))
    ).otherwise(none)
    described = F.transform(
        F.concat("base", others),
        lambda span: F.struct(
            span["start"].alias("start"),
            span["kind"].alias("kind"),
            span["end"].alias("end"),
            span["value"].rlike(_SECRET).alias("secret"),
            _pattern(span).alias("pattern"),
            *(column.alias(name) for name, column in _features(span).items()),
        ),
    )
    return rows.select("doc_id", described.alias("spans"))


def reliabilities(counts: dict[int, int], rounds: int = ROUNDS) -> tuple[list[float], list[list[float]]]:
    """EM over counted vote patterns: chance of personal data per pattern, and right votes.

    Two classes; a labeler that votes is right with a probability of its own in each class.
    Probabilities are kept within [0.05, 0.95], so that no single labeler decides.
    """
    patterns = {}
    for code in range(3**LABELERS):
        rest, votes = code, []
        for _ in range(LABELERS):
            rest, vote = divmod(rest, 3)
            votes.append(vote - 1)
        patterns[code] = votes[::-1]
    right = [[0.75, 0.75] for _ in range(LABELERS)]  # by class: against, for
    share = 0.5
    chance = [0.5] * 3**LABELERS
    for _ in range(rounds):
        for code, votes in patterns.items():
            odds = log(share / (1 - share))
            for (no, yes), vote in zip(right, votes, strict=True):
                if vote:
                    odds += log(yes / (1 - no)) if vote > 0 else log((1 - yes) / no)
            chance[code] = 1 / (1 + 2.718281828459045 ** -max(-30.0, min(30.0, odds)))
        total = sum(counts.values()) or 1
        share = sum(n * chance[code] for code, n in counts.items()) / total
        share = min(0.95, max(0.05, share))
        for i in range(LABELERS):
            for label in (0, 1):
                good = cast = 0.0
                for code, n in counts.items():
                    vote = patterns[code][i]
                    if vote:
                        weight = n * (chance[code] if label else 1 - chance[code])
                        cast += weight
                        good += weight * (vote == (1 if label else -1))
                right[i][label] = min(0.95, max(0.05, (good + 1.5) / (cast + 2)))
    return chance, right


def _lookup(table: list[float], at: Column) -> Column:
    return F.get(F.array(*(F.lit(float(x)) for x in table)), at)


def classifier(found: DataFrame) -> dict[str, list[float]]:
    """Log odds by feature value, and the prior under ``all``; trained on EM's soft labels.

    The three collected tables have a fixed number of rows at most: 3**6 vote patterns, and one
    row per feature value.
    """
    spans = found.select(F.explode("spans").alias("span")).select("span.*")
    votes = {r["pattern"]: r["count"] for r in spans.groupBy("pattern").count().collect()}
    chance, _ = reliabilities(votes)
    total = sum(votes.values())
    positive = sum(n * chance[code] for code, n in votes.items())
    model = {"all": [log((positive + 1) / (total - positive + 1))]}
    features = {"shape": SHAPES, "before": CONTEXTS, "length": LENGTHS}
    # Counted per pattern first: that is exact, and a task sends a row per feature and pattern.
    cells = spans.select(
        "pattern",
        F.explode(F.create_map(*(x for f in features for x in (F.lit(f), F.col(f))))).alias("name", "value"),
    )
    soft = cells.groupBy("name", "value").agg(
        F.sum(_lookup(chance, F.col("pattern"))).alias("yes"), F.count("*").alias("n")
    )
    for name, size in features.items():
        model[name] = [0.0] * size
    for row in soft.collect():
        yes = (row["yes"] + 1) / (positive + 2)
        no = (row["n"] - row["yes"] + 1) / (total - positive + 2)
        model[row["name"]][row["value"]] = max(-4.0, min(4.0, log(yes / no)))
    return model


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of (start, kind, end) in order.

    The four base kinds always stay; words that the classifier accepts come as ``secret`` where
    they look like a key and ``identifier`` otherwise. Empty and null texts have no spans, repeated
    rows repeated ones; other columns are ignored, an empty table gives no rows.
    """
    found = staged(candidates(docs, key, text), "pii-candidates")
    model = classifier(found)

    def accepted(span: Column) -> Column:
        odds = F.lit(model["all"][0])
        for name in ("shape", "before", "length"):
            odds = odds + _lookup(model[name], span[name])
        return (span["kind"] < len(KINDS)) | (odds > 0)

    names = F.array(*map(F.lit, (*KINDS, "identifier")))
    spans = F.transform(
        F.filter("spans", accepted),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["kind"].alias("rank"),
            F.when((s["kind"] == len(KINDS)) & s["secret"], F.lit("secret"))
            .otherwise(F.get(names, s["kind"]))
            .alias("kind"),
            s["end"].alias("end"),
        ),
    )
    return found.select("doc_id", F.sort_array(spans).alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _count_of(rank: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    counts = [_count_of(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; null stays null.

    Where spans overlap, the first one's kind stands for all of them.
    """
    row, key, found = fresh(docs, "row", "key", "found")
    hashed = F.xxhash64("doc_id", text)
    named = docs.withColumn(row, F.struct(F.col("doc_id").alias("key"), hashed.alias("hash")))
    # Equal rows have equal spans, so one of them is enough.
    some = detect(named.where(F.col(text).rlike("[0-9@]")), row, text).where(F.size("spans") > 0)
    spans = some.select(F.col("doc_id").alias(key), F.col("spans").alias(found)).dropDuplicates([key])
    joined = named.join(spans, F.col(row) == F.col(key), "left")
    whole = F.col(text)

    def step(so_far: Column, span: Column) -> Column:
        return F.struct(F.greatest(so_far["at"], span["end"]).alias("at"))

    def put_together(pieces: Column) -> Column:
        def between(first: Column, end: Column) -> Column:
            """The text from code point ``first`` on; only the pieces it touches are looked at."""
            at = F.floor(first / _PIECE).cast("int")
            touched = F.slice(pieces, at + 1, F.floor(end / _PIECE).cast("int") - at + 1)
            return F.substring(F.array_join(touched, ""), first - at * _PIECE + 1, end - first)

        def shown(so_far: Column, span: Column) -> Column:
            made = F.concat(between(so_far["at"], span["start"]), F.lit("<"), F.upper(span["kind"]), F.lit(">"))
            return F.when(span["start"] >= so_far["at"], made)

        end = F.length(whole)
        last = F.aggregate(found, F.lit(0), lambda at, span: F.greatest(at, span["end"]))
        start = F.struct(F.lit(0).alias("at"))
        replaced = _scanned(F.col(found), start, step, shown)
        return F.concat(F.array_join(replaced, ""), let(last, lambda at: between(at, end)))

    places = F.sequence(F.lit(0), (F.length(whole) / _PIECE).cast("int"))
    cut = F.transform(places, lambda i: F.substring(whole, i * _PIECE + 1, F.lit(_PIECE)))
    cleaned = let(cut, put_together)
    shown = F.when(F.col(found).isNull(), whole).otherwise(cleaned)
    return joined.withColumn(text, shown).drop(row, key, found)
