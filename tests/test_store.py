"""Loads that are stopped, repeated or run at once, and what a small load opens."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terratally.plans.warehouse import open_star, save_star
from terratally.plans.loads import load_period, load_reference
from terratally.sources import store as stores
from terratally.sources.store import Store, expire
from tests.drop import MISSIONS
from tests.test_loads import FIRST, LAST, a_drop

FACT = StructType().add("sk", "long").add("nk", "string").add("v", "integer")
CITY = StructType().add("sk_city", "long").add("name", "string").add("country", "string")


def rows(spark, *made):
    """(key, day or None, value)"""
    days = [(k, None if d is None else date.fromisoformat(d), v) for k, d, v in made]
    return spark.createDataFrame(days, "nk string, d date, v int").select(
        F.lit(None).cast("long").alias("sk"), "nk", "v", "d"
    )


def load(spark, root, *made, cities=(), **options):
    store = Store(spark, root)
    store.put_members("city", CITY, spark.createDataFrame(list(cities), CITY), "sk_city")
    store.merge("fact", FACT, rows(spark, *made), "d", "nk", "sk", **options)
    store.commit()


def seen(spark, root):
    store = Store(spark, root)
    table = store.table("city", CITY)
    fact = store.days("fact", FACT, "d")
    return (
        sorted(map(tuple, table.collect())) if table is not None else None,
        sorted(((r.nk, str(r.d), r.v, r.sk, r.year, r.month, r.day) for r in fact.collect()), key=str),
    )


BEFORE = (("K0001", "2026-05-01", 1), ("K0002", "2026-05-01", 2), ("K0003", "2026-05-02", 3), ("K0004", None, 4))
AFTER = (("K0002", "2026-05-03", 20), ("K0005", "2026-05-02", 5), ("K0006", None, 6))
CITIES = [(1, "Paris", "FR"), (2, "Rome", None)]
GROWN = [(2, "Rome", "IT"), (3, "Oslo", "NO")]


def test_rows_move_and_keep_their_keys(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, *BEFORE, cities=CITIES)
    load(spark, root, *AFTER, cities=GROWN)
    cities, fact = seen(spark, root)
    assert cities == [(1, "Paris", "FR"), (2, "Rome", "IT"), (3, "Oslo", "NO")]
    assert [(r[0], r[1], r[2], r[3]) for r in fact] == [
        ("K0001", "2026-05-01", 1, 1), ("K0002", "2026-05-03", 20, 2), ("K0003", "2026-05-02", 3, 3),
        ("K0004", "None", 4, 4), ("K0005", "2026-05-02", 5, 5), ("K0006", "None", 6, 6),
    ]
    load(spark, root, ("K0001", "2026-05-09", 0), ("K0007", "2026-05-01", 7), only_new=True)
    assert [r[:4] for r in seen(spark, root)[1] if r[0] in ("K0001", "K0007")] == [
        ("K0001", "2026-05-01", 1, 1), ("K0007", "2026-05-01", 7, 7),
    ]


def test_a_load_stopped_anywhere_changes_nothing(spark, tmp_path, monkeypatch):
    whole, root = str(tmp_path / "whole"), str(tmp_path / "torn")
    for at in (whole, root):
        load(spark, at, *BEFORE, cities=CITIES)
    load(spark, whole, *AFTER, cities=GROWN)
    before, write, stops = seen(spark, root), stores.write_part, 0
    while True:
        done = []

        def torn(*args, stop=stops, done=done):
            if len(done) == stop:
                write(args[0].limit(1), *args[1:])  # half of the part is there
                raise OSError("stopped")
            done.append(write(*args))

        monkeypatch.setattr(stores, "write_part", torn)
        try:
            load(spark, root, *AFTER, cities=GROWN)
            break
        except OSError:
            assert seen(spark, root) == before
            stops += 1
    assert stops == 3  # the cities, the fact, its index
    assert seen(spark, root) == seen(spark, whole)


def test_stopped_before_the_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load(spark, root, *BEFORE, cities=CITIES)
    before = seen(spark, root)
    with monkeypatch.context() as patched:
        patched.setattr(Store, "commit", lambda self: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            load(spark, root, *AFTER, cities=GROWN)
    assert seen(spark, root) == before
    assert expire(spark, root, 1) > 0
    assert seen(spark, root) == before
    load(spark, root, *AFTER, cities=GROWN)
    assert len(seen(spark, root)[1]) == 6


def test_of_two_loads_at_once_one_fails(spark, tmp_path):
    root = str(tmp_path)
    one, other = Store(spark, root), Store(spark, root)
    for store, key in ((one, "A"), (other, "B")):
        store.merge("fact", FACT, rows(spark, (key, "2026-05-01", 1)), "d", "nk", "sk")
    other.commit()
    with pytest.raises(RuntimeError, match="another load"):
        one.commit()
    assert [r[0] for r in seen(spark, root)[1]] == ["B"]


def test_a_reader_keeps_what_it_opened(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, *BEFORE, cities=CITIES)
    opened = Store(spark, root).days("fact", FACT, "d")
    load(spark, root, *AFTER, cities=GROWN)
    assert opened.count() == 4
    assert expire(spark, root, 1) > 0
    assert len(seen(spark, root)[1]) == 6


def test_many_small_loads_are_written_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "MOST_PARTS", 2)
    root = str(tmp_path)
    for i in range(5):
        load(spark, root, (f"K{i:04d}", "2026-05-01", i), ("K0000", "2026-05-01", i), cities=[(i, f"c{i}", None)])
    store = Store(spark, root)
    assert len(store.base.days["fact"]["2026-05-01"]) <= 2
    assert all(len(loads) <= 2 for loads in store.base.index["fact"].values())
    assert len(store.base.tables["city"]) <= 2
    cities, fact = seen(spark, root)
    assert [c[0] for c in cities] == [0, 1, 2, 3, 4]
    # K0000 came twice in the first load, and once in each later one.
    assert [r[0] for r in fact] == ["K0000", "K0001", "K0002", "K0003", "K0004"]
    assert len({r[3] for r in fact}) == len(fact)


def test_repeated_and_missing_keys(spark, tmp_path):
    root = str(tmp_path)
    made = (("A", "2026-05-01", 1), ("A", "2026-05-02", 2), (None, "2026-05-01", 3), (None, "2026-05-01", 3))
    load(spark, root, *made)
    assert len(seen(spark, root)[1]) == 4
    load(spark, root, ("A", "2026-05-03", 9))
    fact = Store(spark, root).days("fact", FACT, "d").collect()
    assert sorted((str(r.nk), str(r.d), r.v) for r in fact) == [
        ("A", "2026-05-03", 9), ("None", "2026-05-01", 3), ("None", "2026-05-01", 3),
    ]
    assert len({r.sk for r in fact}) == 3
    load(spark, str(tmp_path / "none"))
    assert seen(spark, str(tmp_path / "none"))[1] == []


def test_a_small_load_opens_its_days_and_buckets_alone(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    many = [(f"N{i:08d}", f"2026-{1 + i % 9:02d}-{1 + i % 28:02d}", i) for i in range(0, 900_000, 1000)]
    load(spark, root, *many)
    opened = []
    parts = Store._parts

    def noted(self, layout, base, paths):
        opened.append((base, paths))
        return parts(self, layout, base, paths)

    monkeypatch.setattr(Store, "_parts", noted)
    load(spark, root, many[7], ("N00007001", "2026-02-02", 1))
    days = [p for base, paths in opened for p in paths if base.endswith("/fact") and "_index" not in base]
    buckets = [p for base, paths in opened for p in paths if "_index" in base]
    assert len(days) == 1 and "month=8/day=1/" in days[0]
    assert len(buckets) == 1
    state = Store(spark, root).base
    assert len(state.days["fact"]) > 50 and len(state.index["fact"]) > 20
    plan = Store(spark, root).where_kept("fact", "nk", rows(spark, many[7]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Location: InMemoryFileIndex(1 paths)" in text or "InMemoryFileIndex(2 paths)" in text


def test_star_stopped_and_repeated(spark, tmp_path, monkeypatch):
    drop, root = a_drop(tmp_path / "d", missions=MISSIONS[:6]), str(tmp_path / "star")
    reference = load_reference(spark, drop)
    save_star(load_period(spark, drop, FIRST, LAST, reference), root)
    more = load_period(spark, a_drop(tmp_path / "e", missions=MISSIONS[4:]), FIRST, LAST, reference)

    def everything():
        star = open_star(spark, root)
        return {name: sorted(map(str, table.collect())) for name, table in star.tables().items()}

    before, write = everything(), stores.write_part
    for stop in (1, 2):
        left = [stop]

        def torn(*args, left=left):
            left[0] -= 1
            if not left[0]:
                raise OSError("stopped")
            write(*args)

        with monkeypatch.context() as patched:
            patched.setattr(stores, "write_part", torn)
            with pytest.raises(OSError):
                save_star(more, root)
        assert everything() == before
    save_star(more, root)
    after = everything()
    assert len(after["fact_mission"]) > len(before["fact_mission"])
    save_star(more, root)
    assert everything() == after
