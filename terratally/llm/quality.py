"""Quality rules whose strictness a document's host decides.

Each document is measured once, natively. Rule failures are added up per host, each host's failure
rate is shrunk towards all hosts with a beta prior estimated from them, and the verdict on the
host goes back to its documents: a trusted host's document may fail one rule, a suspect one's none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.llm.common import fresh, let, staged

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A host is suspect from this shrunk failure rate of any one rule on.
SUSPECT_RATE = 0.3
TRUSTED_FAILURES = 1
#: Up to so many repeated windows are looked up one by one.
_FEW = 32

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda word: word != "")


def _repeated(words: Column) -> Column:
    """Words within three-word windows that occur more than once in the text.

    Windows are compared by hash. Sorting them shows which values repeat, mostly none or a few;
    only a text with many is sorted again together with the places.
    """
    windows = F.slice(
        F.transform(
            words,
            lambda _, i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
        1,
        F.greatest(F.size(words) - 2, F.lit(0)),
    )

    def places(windows: Column) -> Column:
        return let(
            let(
                F.sort_array(windows),
                lambda ordered: F.filter(ordered, lambda w, j: w == F.get(ordered, j - 1)),
            ),
            lambda repeats: F.when(F.size(repeats) == 0, F.array().cast("array<int>"))
            .when(F.size(repeats) <= _FEW, _places_of(windows, repeats))
            .otherwise(_places_by_sorting(windows)),
        )

    covered = F.aggregate(
        let(windows, places),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda so_far, p: F.struct(
            (so_far["n"] + F.least(F.lit(3), p - so_far["last"])).alias("n"), p.alias("last")
        ),
        lambda so_far: so_far["n"],
    )
    return covered.cast("long")


def _places_of(windows: Column, repeats: Column) -> Column:
    return F.array_compact(
        F.transform(windows, lambda w, i: F.when(F.array_contains(repeats, w), i))
    )


def _places_by_sorting(windows: Column) -> Column:
    """Equal neighbours in the order of (window, place) are repeats."""
    return let(
        F.sort_array(
            F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("p")))
        ),
        lambda ordered: F.sort_array(
            F.array_compact(
                F.transform(
                    ordered,
                    lambda x, j: F.when(
                        (x["w"] == F.get(ordered, j - 1)["w"])
                        | (x["w"] == F.get(ordered, j + 1)["w"]),
                        x["p"],
                    ),
                )
            )
        ),
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def measured(docs: DataFrame, key: str, host: str, text: str = "text") -> DataFrame:
    """``key``, ``host`` and the measures of each whole text; null text has none, so all are 0."""
    whole = F.coalesce(F.col(text), F.lit(""))
    numbers = let(
        _words(whole),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated(words).alias("n_repeat_words"),
        ),
    )
    lines = let(
        _lines(whole),
        lambda kept: F.struct(
            F.size(kept).cast("long").alias("n_lines"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
        ),
    )
    return docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        numbers.alias("numbers"),
        lines.alias("lines"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    ).select("doc_id", "host", "numbers.*", "lines.*", "n_symbols")


def base_failed() -> Column:
    too_short = F.col("n_words") < MIN_WORDS
    return too_short | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)


def soft_rules() -> dict[str, Column]:
    """Rules that one document may fail by chance; in whole numbers, so that SQL agrees."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbols": F.col("n_symbols") * 10 > words,
        "word_length": (chars * 10 < words * 25) | (chars > words * 12),
        "duplicate_lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
        "repeated_words": F.col("n_repeat_words") * 10 > words * 3,
        "short": words < MIN_WORDS,
    }


def host_rates(measures: DataFrame) -> DataFrame:
    """One row per host and rule: documents, failures, and the rate shrunk by the beta prior.

    The prior of a rule is fitted by moments: its mean is the overall rate, its spread is what
    the variance between hosts exceeds that of sampling. Hosts that hold a third of all rows are
    counted in the map tasks first, and the prior comes from the table of hosts.
    """
    rules = soft_rules()
    counts = measures.groupBy("host").agg(
        F.count("*").alias("documents"),
        *(F.sum(F.when(failed, 1).otherwise(0)).alias(name) for name, failed in rules.items()),
    )
    by_rule = counts.select(
        "host",
        "documents",
        F.explode(F.create_map(*(x for n in rules for x in (F.lit(n), F.col(n))))).alias(
            "rule", "failures"
        ),
    )
    n, rate = F.col("documents"), F.col("failures") / F.col("documents")
    overall = by_rule.groupBy("rule").agg(
        F.count("*").alias("hosts"),
        F.sum("documents").alias("all_documents"),
        (F.sum("failures") / F.sum("documents")).alias("mean"),
        (F.sum(n * rate * rate) / F.sum("documents")).alias("mean_square"),
    )
    chance = F.col("mean") * (1 - F.col("mean"))
    spread = F.col("mean_square") - F.col("mean") ** 2 - F.col("hosts") * chance / F.col("all_documents")
    strength = F.least(F.greatest(chance / F.greatest(spread, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e6))
    prior = overall.select("rule", "mean", strength.alias("strength"))
    # One row per rule, whatever the input.
    return by_rule.join(F.broadcast(prior), "rule").select(
        "host",
        "rule",
        "documents",
        "failures",
        ((F.col("failures") + F.col("mean") * F.col("strength")) / (n + F.col("strength"))).alias("rate"),
    )


def host_verdicts(rates: DataFrame, suspect_rate: float = SUSPECT_RATE) -> DataFrame:
    """One row per host: its highest shrunk rate and whether it is suspect."""
    worst = rates.groupBy("host").agg(F.max("rate").alias("host_rate"))
    return worst.withColumn("host_suspect", F.col("host_rate") > suspect_rate)


def judge(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    suspect_rate: float = SUSPECT_RATE,
) -> DataFrame:
    """One row per input row: measures, ``base_failed``, host verdict and ``kept``.

    Documents without a host share one. Repeated rows and keys are judged one by one, other
    columns are ignored, an empty text fails, an empty table gives no rows.
    """
    measures = staged(measured(docs, key, host, text), "quality-measures")
    verdicts = host_verdicts(host_rates(measures), suspect_rate)
    failures = sum((failed.cast("int") for failed in soft_rules().values()), F.lit(0))
    allowed = F.when(F.col("host_suspect"), 0).otherwise(TRUSTED_FAILURES)
    return (
        measures.join(verdicts, "host")
        .withColumn("base_failed", base_failed())
        .withColumn("n_failures", failures)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_failures") <= allowed))
    )


def kept(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Rows are judged one by one even where keys repeat: a row is known by its key, host and the
    hash of its text, and rows equal in these get the same verdict.
    """
    row, good = fresh(docs, "row", "good")
    hashed = F.xxhash64(F.col(key), F.col(host), F.col(text))
    named = docs.withColumn(row, F.struct(F.col(key).alias("key"), hashed.alias("hash")))
    keys = judge(named, row, host, text).where("kept").select(F.col("doc_id").alias(good)).distinct()
    return named.join(keys, F.col(row) == F.col(good), "left_semi").drop(row)


#: DuckDB SQL for the digest of ``judge`` over documents.
QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d
), tri AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n > 1
), cover AS (
  SELECT rid, sum(least(3, i - coalesce(before, -9))) AS n_repeat_words
  FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM rep) GROUP BY rid
), m AS (
  SELECT rid, doc_id, host, len(words) AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    list_filter(string_split(text, E'\n'), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d JOIN w USING (rid) LEFT JOIN cover USING (rid)
), f AS (
  SELECT * EXCLUDE (lines), len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    (n_symbols * 10 > n_words)::INT AS r1,
    (word_chars * 10 < n_words * 25 OR word_chars > n_words * 12)::INT AS r2,
    ((len(lines) - len(list_distinct(lines))) * 10 > len(lines) * 3)::INT AS r3,
    (n_repeat_words * 10 > n_words * 3)::INT AS r4,
    (n_words < 50)::INT AS r5
  FROM m
), h AS (
  SELECT host, count(*) AS n, unnest([sum(r1), sum(r2), sum(r3), sum(r4), sum(r5)]) AS x,
    unnest([1, 2, 3, 4, 5]) AS rule FROM f GROUP BY host
), o AS (
  SELECT rule, count(*) AS hosts, sum(n) AS total, sum(x) / sum(n) AS p,
    sum(n * (x / n) * (x / n)) / sum(n) AS sq FROM h GROUP BY rule
), prior AS (
  SELECT rule, p, least(greatest(p * (1 - p) / greatest(sq - p * p - hosts * p * (1 - p) / total, 1e-9) - 1, 1.0), 1e6) AS k FROM o
), v AS (
  SELECT host, max((x + p * k) / (n + k)) > 0.3 AS suspect FROM h JOIN prior USING (rule) GROUP BY host
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND r1 + r2 + r3 + r4 + r5 <= CASE WHEN suspect THEN 0 ELSE 1 END AS kept
FROM (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM f) JOIN v USING (host)
"""
