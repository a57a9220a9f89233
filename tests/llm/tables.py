"""Small tables with odd rows, and plain-Python reckonings to hold results against."""

from __future__ import annotations

from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "row string, key string, hash string, node string, n string, row_hash string, spans string, "
    "place string, number string, good string, found string, host string, kept string"
)
PROSE = (
    "The quick brown fox walks over the wide green field and meets an old grey badger there. "
    "They talk about the weather of last week, the price of corn in town, and how the river rose "
    "after so much rain had come down from the northern hills. Then each of them goes home again."
)


def odd_rows() -> list[tuple]:
    """Nulls, empty texts, repeated rows and ids, ties, one very long text."""
    long_text = " ".join(f"word{i % 977} and item{i % 1013}" for i in range(30_000))
    other = PROSE.replace("badger", "weasel")
    rows = [
        (1, PROSE, "en", "a", 1),
        (1, PROSE, "en", "a", 1),
        (1, "something else altogether in one short line", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n\r\x0b\x0c ", "en", "b", 7),
        (None, PROSE.upper(), None, None, None),
        (None, None, None, None, None),
        (5, other, "en", "b", 2),
        (6, "one two", "en", "b", 2),
        (7, "ONE  two", "en", "b", 2),
        (8, long_text, "en", "c", 3),
        (9, long_text + " end", "en", "c", 3),
        (-7, "Ünï cödé ﷐ \x00 text 💡 " * 20, "de", "c", 3),
    ]
    return rows


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def with_clashes(frame):
    from pyspark.sql import functions as F

    names = [column.split()[0] for column in CLASHING.split(", ")]
    return frame.select("*", *(F.lit("x").alias(name) for name in names))


def as_counts(rows) -> Counter:
    return Counter(tuple(row) for row in rows)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def components(nodes, linked) -> dict:
    """Smallest reachable node by plain search over ``linked(a, b)``."""
    nodes = sorted(nodes)
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {node: find(node) for node in nodes}
