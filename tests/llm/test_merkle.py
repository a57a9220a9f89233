"""Manifests against a plain tree built in Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences, duckdb_result, spark_result
from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, odd_rows, with_clashes
from terratally.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(digests):
    """Root, and the steps of every place."""
    steps, nodes, above = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(nodes) > 1:
        for at, node in enumerate(above):
            run = nodes[node // 16 * 16 : node // 16 * 16 + 16]
            steps[at].append(("".join(run[: node % 16]), "".join(run[node % 16 + 1 :])))
            above[at] = node // 16
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], steps


def plain(rows):
    sources = defaultdict(list)
    for row in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]) if row[1] is not None else None
        chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        shown = leaf_of(row[0], low if chosen else row[1], *row[2:])
        sources[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(*row), shown, row[0]))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        sources[name].sort()
        trees.append(climb([leaf[2] for leaf in sources[name]]))
    root, above = climb([top for top, _ in trees]) if trees else (None, [])
    out = []
    for name, (top, steps), upper in zip(names, trees, above):
        for (_, _, leaf, shown, key), own in zip(sources[name], steps):
            path, folded = own + upper, shown
            for left, right in path:
                folded = digest(left, folded, right)
            proof = digest(*(left + right for left, right in path))
            out.append((key, leaf, top, root, proof, folded, folded == root))
    return Counter(out)


def found(documents):
    rows = merkle.verify(merkle.manifest(documents, merkle.tampered_text())).collect()
    return Counter(tuple(r) for r in rows)


def test_table(spark):
    documents = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    rows = merkle.verify(merkle.manifest(documents, merkle.tampered_text()))
    mine = spark_result(rows)
    assert differences(mine, duckdb_result(connect(TESTDATA), merkle.MANIFEST_SQL)) == ""
    columns = documents.select("doc_id", "text", "lang", "source", "n_chars")
    wanted = plain([tuple(r) for r in columns.collect()])
    assert Counter(tuple(r) for r in rows.collect()) == wanted
    assert len({r[-1] for r in wanted}) == 2


def test_odd_rows(spark):
    assert found(with_clashes(odd_documents(spark))) == plain(odd_rows())
    assert found(spark.createDataFrame([], SCHEMA)) == Counter()


@pytest.mark.parametrize("size", [1, 2, 16, 17, 257])
def test_one_source(spark, size):
    """Whole runs, a last run of one, and a lone leaf, which is the root."""
    rows = [(i, f"Text {i}", "en", "only", i) for i in range(size)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_many_sources_and_a_hot_one(spark):
    rows = [(i, f"Text {i}", None, f"s{i}" if i % 2 else "hot", i) for i in range(700)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_untouched_rows_verify(spark):
    """Every proof leads to the root as long as the text is the one of the manifest."""
    documents = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    rows = merkle.verify(merkle.manifest(documents))
    assert rows.where(~F.col("verified")).count() == 0
