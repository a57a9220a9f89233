from datetime import date, timedelta
from fnmatch import fnmatchcase

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from terratally.schemas import MISSION_FILE, PERSONNEL_FILE
from terratally.sources.delimited import (
    Drop,
    days_glob,
    read_delimited,
    read_mission_days,
    read_purchase_days,
)
from terratally.sources.places import places, read_city_cache
from terratally.sources.warehouse import missing_days, read_days, write_days
from tests.drop import MISSION_HEADER, MISSIONS, PURCHASES


def test_period_selects_days_and_sites(spark, drop):
    found = read_mission_days(spark, drop, date(2026, 5, 1), date(2026, 5, 31))
    assert sorted(r.ID_MISSION for r in found.collect()) == ["M01", "M02", "M06"]
    only_paris = Drop(drop.root, ("PARIS",))
    found = read_mission_days(spark, only_paris, date(2026, 5, 1), date(2026, 12, 31))
    assert found.count() == sum(m[0] == "PARIS" for m in MISSIONS)


def test_period_without_files(spark, drop):
    with pytest.raises(ValueError, match="no mission file"):
        read_mission_days(spark, drop, date(2026, 1, 1), date(2026, 1, 31))
    nothing = read_purchase_days(spark, drop, date(2026, 1, 1), date(2026, 1, 31))
    assert nothing.count() == 0


def test_missing_staff_file_is_an_error(spark, drop):
    elsewhere = Drop(drop.root, ("PARIS", "ROME"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_delimited(spark, elsewhere.personnel(), schema=PERSONNEL_FILE)


def test_all_purchases_are_read(spark, drop):
    found = read_purchase_days(spark, drop, date(2026, 1, 1), date(2026, 12, 31))
    assert found.count() == len(PURCHASES)


def test_blank_fields_are_null_and_values_trimmed(spark, drop):
    found = read_purchase_days(spark, drop, date(2026, 6, 1), date(2026, 7, 31))
    models = {r.ID_MATERIELINFO: (r.TYPE, r.MODELE) for r in found.collect()}
    assert models["E01"] == ("PC portable", "OMEN")
    assert models["E03"] == ("Ecran", None)
    assert models["E05"] == (None, "OMEN")


def test_comma_file_takes_its_names_from_the_header(spark, drop):
    found = read_delimited(spark, drop.impacts(), ",")
    assert found.columns == ["Type", "Modèle", "Impact"]
    assert dict(found.dtypes)["Impact"] == "string"


def test_reordered_header_is_refused(spark, tmp_path):
    names = MISSION_HEADER.split(";")
    names[0], names[1] = names[1], names[0]
    path = tmp_path / "MISSION_20260501.txt"
    path.write_text(";".join(names) + "\n" + ";".join("x" * 12) + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        read_delimited(spark, str(path), schema=MISSION_FILE).collect()


@pytest.mark.parametrize(
    ("first", "last"),
    [
        (date(2026, 5, 1), date(2026, 5, 1)),
        (date(2026, 4, 29), date(2026, 5, 7)),
        (date(2026, 1, 1), date(2027, 12, 31)),
        (date(2026, 2, 10), date(2026, 4, 30)),
    ],
)
def test_days_glob_matches_exactly_the_period(first, last):
    patterns = days_glob(first, last).strip("{}").split(",")
    day = date(2025, 12, 1)
    while day < date(2028, 2, 1):
        matched = any(fnmatchcase(f"{day:%Y%m%d}", p) for p in patterns)
        assert matched == (first <= day <= last), day
        day += timedelta(days=1)


def test_city_cache_overrides_and_adds(spark, tmp_path):
    path = tmp_path / "city_coordinates.json"
    path.write_text('{"Paris": [1.0, 2.0], "Lille": null, "Atlantis": [30.0, -40.0]}')
    assert read_city_cache(spark, str(path)).count() == 3
    rows = {r.city_name: r for r in places(spark, str(path)).collect()}
    assert (rows["Paris"].lat, rows["Paris"].timezone_iana) == (1.0, "Europe/Paris")
    assert rows["Atlantis"].timezone_iana == "Etc/GMT+3"
    assert rows["Lille"].lat is None and rows["Lille"].timezone_iana is None
    assert rows["Berlin"].lat == 52.52


def test_days_are_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "fact")

    def days(*rows):
        frame = spark.createDataFrame(rows, "v int, d string")
        return frame.select("v", F.to_date("d").alias("d"))

    write_days(days((1, "2026-05-01"), (2, "2026-05-02")), path, "d")
    write_days(days((3, "2026-05-02")), path, "d")
    assert sorted(r.v for r in read_days(spark, path).collect()) == [1, 3]
    pruned = read_days(spark, path, date(2026, 5, 2), date(2026, 5, 31))
    assert [r.v for r in pruned.collect()] == [3]
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().toString()


def test_missing_days(spark):
    incoming = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "d string")
    loaded = spark.createDataFrame([("a",)], "d string")
    assert [r.d for r in missing_days(incoming, loaded, "d").collect()] == ["b"]
