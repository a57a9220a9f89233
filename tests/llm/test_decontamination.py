"""Leaked benchmark items: verbatim, re-parameterised, and texts that only look alike."""

import re
from collections import defaultdict

import pytest

from tests.conftest import TESTDATA
from tests.llm.tables import PROSE, SCHEMA, odd_documents, with_clashes
from terratally.llm import decontamination
from terratally.llm.queries import QUERIES

ITEM = (
    "Yesterday the farmer Miller sold 12 kg of apples to his neighbour Jones for 30 dollars "
    "and then carried 12 kg more to the market in the old town."
)
FILL = " ".join(f"filler{i}" for i in range(40))
ITEMS = "item_id long, text string"


def judged(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    found = decontamination.decontaminate(docs, spark.createDataFrame(list(items), ITEMS))
    return {r["doc_id"]: r for r in found.collect()}


def test_verbatim_and_new_values(spark):
    changed = ITEM.replace("12", "75").replace("30", "8").replace("Miller", "Weber")
    got = judged(spark, [f"{FILL}\n{ITEM} {FILL}", f"{FILL}. {changed} {FILL}", FILL, ITEM.upper()])
    assert [got[i]["contaminated"] for i in range(4)] == [True, True, False, True]
    assert got[0]["coverage"] == 1.0 and not got[0]["changed"] and got[1]["changed"]
    assert got[0]["item_id"] == 1 and got[2]["item_id"] is None


def test_slots_must_be_consistent(spark):
    """12 stands in two slots of the item, so it has to become one value."""
    torn = "sold 75 kg of apples to his neighbour Jones for 30 dollars and then carried 88 kg more to the market"
    whole = torn.replace("88", "75")
    windows = {i: r["n_windows"] for i, r in judged(spark, [f"He {torn} in", f"He {whole} in"]).items()}
    assert windows[1] > 0 and windows[0] == 0


def test_verbatim_windows_count_beside_torn_slots(spark):
    """One of two equal values is edited: what stands between is still verbatim."""
    torn = "sold 75 kg of apples to his neighbour Jones for 30 dollars and then carried 88 kg more to the market"
    edited = ITEM.replace("carried 12", "carried 13")
    got = judged(spark, [f"He {torn} in", f"{FILL} {edited} {FILL}", FILL])
    assert [got[i]["contaminated"] for i in range(3)] == [True, True, False]
    assert [got[i]["n_verbatim"] for i in range(3)] == [6, 14, 0]


def test_short_items_and_ties(spark):
    items = [(5, "what is it called"), (3, "what is it called"), (9, ""), (None, None)]
    got = judged(spark, ["well what is it called then", "nothing here"], items)
    assert got[0]["contaminated"] and got[0]["n_items"] == 2 and got[0]["item_id"] == 3
    assert not got[1]["contaminated"]


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    items = spark.createDataFrame([(1, PROSE)], ITEMS)
    found = decontamination.decontaminate(docs, items).collect()
    assert len(found) == docs.count() and sum(r["contaminated"] for r in found) == 4
    kept = decontamination.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    no_items = items.where("item_id = 0")
    assert decontamination.clean(docs, no_items).count() == docs.count()
    assert decontamination.clean(docs.limit(0), items).count() == 0


def test_table_against_plain_search(spark):
    """Every document with thirteen words in a row of an item is found; none without eight."""
    found = {r["doc_id"]: r["contaminated"] for r in QUERIES["op2_benchmark_decontamination"](spark, TESTDATA).collect()}

    def runs(text, n):
        import re

        words = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    items = [r["text"] for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    long = set().union(*(runs(t, 13) for t in items))
    short = set().union(*(runs(t, 8) for t in items))
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc in docs:
        if runs(doc["text"], 13) & long:
            assert found[doc["doc_id"]], doc["doc_id"]
        elif not runs(doc["text"], 8) & short:
            assert not found[doc["doc_id"]], doc["doc_id"]


def plain_tokens(text):
    """(word, placeholder or word, value or None, begins a sentence) per word, by reading along."""
    out, end, after_number = [], 0, False
    for match in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text or ""):
        raw = match.group()
        word = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
        first = not out or any(c in "\n!.:?" for c in text[end : match.start()])
        number = raw[0] in "0123456789"
        if number:
            kind = "<number>"
        elif "A" <= raw[0] <= "Z" and len(raw) > 1 and "a" <= raw[1] <= "z" and not first:
            kind = "<name>"
        elif after_number and word in decontamination.UNITS:
            kind = "<unit>"
        else:
            kind = None
        out.append((word, kind or word, word if kind else None, first))
        end, after_number = match.end(), number
    return out


def plain_windows(tokens, size):
    """(key, position, values or None) of the windows that count for items of this many words."""
    for i in range(len(tokens) - size + 1):
        part = tokens[i : i + size]
        if size < 4 and len(tokens) != size:
            continue
        yield ("plain", *(t[0] for t in part)), i, None
        slots = sum(t[2] is not None for t in part)
        sentence = part[0][3] and (i + size == len(tokens) or tokens[i + size][3])
        if slots and (size - slots >= 4 or size < 8 and sentence and size - slots >= 2):
            yield ("shape", *(t[1] for t in part)), i, tuple(t[2] for t in part)


def plain_matches(docs, items):
    """Rows of ``matches`` without the hashes, by comparing every document with every item."""
    out = set()
    made = []
    for key, text in items:
        tokens = plain_tokens(text)
        if tokens:
            size = min(8, len(tokens))
            windows = defaultdict(list)
            for window, at, values in plain_windows(tokens, size):
                windows[window].append((at, values))
            made.append((key, size, len(tokens) - size + 1, windows))
    for doc, text in docs:
        tokens = plain_tokens(text)
        by_size = {size: list(plain_windows(tokens, size)) for size in {m[1] for m in made}}
        for key, size, total, windows in made:
            slots, positions, verbatim = defaultdict(set), defaultdict(set), defaultdict(set)
            for window, at, values in by_size[size]:
                for item_at, item_values in windows.get(window, ()):
                    line = at - item_at
                    positions[line].add(item_at)
                    if values is None:
                        verbatim[line].add(item_at)
                    else:
                        slots[line] |= {(a, b) for a, b in zip(item_values, values) if a is not None}
            good = {x for x in positions if len(slots[x]) == len({a for a, _ in slots[x]})}
            n_windows = set().union(*(positions[x] for x in good))
            n_verbatim = set().union(*verbatim.values())
            if n_windows | n_verbatim:
                n = len(n_windows | n_verbatim)
                changed = any(a != b for x in good for a, b in slots[x])
                out.add((doc, key, len(n_windows), len(n_verbatim), n, round(min(1.0, n / total), 9), changed))
    return out


def found_matches(spark, docs, items):
    rows = decontamination.matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    ).collect()
    return {
        (r["doc_id"], r["item_id"], r["n_windows"], r["n_verbatim"], r["n_matched"], round(r["coverage"], 9), r["changed"])
        for r in rows
    }


def test_templates_against_brute_force(spark):
    """Windows, templates, slots and coverage of made-up texts with edited values."""
    items = [
        (1, ITEM), (2, "What is 12 plus 7?"), (3, "Yes"), (4, "How far is 5 km in miles"), (5, "12 and 12"),
        (6, "The train from Paris leaves at 9 h. How many km are 9 h at 80 kmh? Take 9 h in all cases, says Paul."),
        (7, "one two three four"), (8, ""), (9, "Is 7 prime now"), (10, "Ünï 3 kg cödé und 4 kg mehr davon, nicht 3 kg"),
    ]
    texts = [t for _, t in items]
    texts += [ITEM.replace(a, b) for a, b in (("12", "75"), ("30", "8"), ("Miller", "Weber"), ("kg", "lb"), ("carried 12", "carried 13"))]
    texts += [
        "Q: What is 15 plus 9? Answer", "we know what is 15 plus 9 here", "What is 15 plus 9 now?", "What is plus 7",
        "we say yes to all the things", "YES!", "Well. How far is 8 mi in miles?", "13 and 12", "13 and 13",
        texts[5].replace("9", "11"), texts[5].replace("Take 9", "Take 10"), texts[5].replace("Paul", "Anna").lower(),
        "one two three four five", "x one two\nthree four", "Ünï 8 kg cödé und 5 kg mehr davon, nicht 8 kg", f"{ITEM} {ITEM.replace('12', '14')}",
    ]
    docs = [(i, f"{a}{t}{b}") for i, (t, a, b) in enumerate((t, *w) for t in texts for w in (("", ""), ("so ", " etc"), ("Ok. ", ". End")))]
    wanted = plain_matches(docs, items)
    assert {m[1] for m in wanted} == {1, 2, 3, 4, 5, 6, 7, 9, 10} and any(m[6] for m in wanted)
    assert found_matches(spark, docs, items) == wanted


def test_table_against_brute_force(spark):
    """Documents of the table against its whole benchmark."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    wanted = plain_matches(docs, items)
    assert wanted and found_matches(spark, docs, items) == wanted


@pytest.mark.parametrize(
    ("item", "text", "leaked"),
    [
        ("What is 12 plus 7", "Q: What is 15 plus 9? Think.", True),
        ("What is 12 plus 7", "They ask what is 15 plus 9 of them", False),
        ("What is 12 plus 12", "What is 15 plus 9?", False),
        ("What is 12 plus 12", "What is 15 plus 15?", True),
        ("Yes", "we say yes to all the things", False),
        ("Yes", "We do. Yes. We do", False),
        ("Yes", " yes!\n", True),
    ],
)
def test_short_items(spark, item, text, leaked):
    assert judged(spark, [text], [(1, item)])[0]["contaminated"] == leaked
