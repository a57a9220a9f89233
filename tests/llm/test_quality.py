"""Quality rules by host: measures, prior and verdicts."""

from tests.compare import connect, differences, duckdb_result, spark_result
from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, with_clashes
from terratally.llm import quality
from terratally.llm.queries import QUERIES, SQL


def measures(spark, text):
    row = quality.measured(spark.createDataFrame([(1, text, "h")], "d long, text string, s string"), "d", "s")
    return row.first().asDict()


def test_measures(spark):
    got = measures(spark, "a b c d\na b c\n\na b c\nx $1 <2>\n")
    assert got["n_words"] == 13
    assert got["n_lines"] == 4 and got["n_dup_lines"] == 1
    assert got["n_symbols"] == 3 and got["word_chars"] == 16
    assert got["n_repeat_words"] == 9  # a b c, three times


def test_many_repeats_take_the_other_path(spark):
    lines = " ".join(f"p{i} q{i} r{i}" for i in range(100))
    assert measures(spark, f"{lines} {lines}")["n_repeat_words"] == 600
    assert measures(spark, "of " * 50)["n_repeat_words"] == 50
    assert measures(spark, "one two")["n_repeat_words"] == 0


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, h, None) for i, (t, h) in enumerate(rows)], SCHEMA)


def test_host_decides_for_a_single_failure(spark):
    plain = " ".join(f"word{i}" for i in range(60))
    symbols = plain + " #" * 10
    rows = [(symbols, "bad")] * 40 + [(plain, "bad")] * 10 + [(symbols, "good")] * 2 + [(plain, "good")] * 200
    rows += [(plain, f"host{i}") for i in range(20)]
    kept = {(r["host"], r["n_symbols"] > 0): r["kept"] for r in quality.judge(documents(spark, rows)).collect()}
    assert kept[("bad", True)] is False and kept[("good", True)] is True
    assert kept[("bad", False)] is True and kept[("good", False)] is True


def test_rates_are_shrunk_towards_all_hosts(spark):
    plain = " ".join(f"word{i}" for i in range(60))
    rows = [("few words", "tiny")] + [(plain, f"h{i % 10}") for i in range(500)]
    rates = quality.host_rates(quality.measured(documents(spark, rows), "doc_id", "source"))
    tiny = {r["rule"]: r["rate"] for r in rates.where("host = 'tiny'").collect()}
    assert 0 < tiny["short"] < 1


def test_odd_rows(spark):
    docs = odd_documents(spark)
    judged = quality.judge(with_clashes(docs)).collect()
    assert len(judged) == docs.count()
    assert all(not r["kept"] for r in judged if r["n_words"] < 50)
    kept = quality.kept(with_clashes(docs))
    assert kept.columns == with_clashes(docs).columns
    assert kept.count() == sum(r["kept"] for r in judged)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.judge(empty).collect() == [] and quality.kept(empty).collect() == []


def test_same_as_sql(spark):
    found = spark_result(QUERIES["op3_quality_rules"](spark, TESTDATA))
    assert differences(found, duckdb_result(connect(TESTDATA), SQL["op3_quality_rules"])) == ""
