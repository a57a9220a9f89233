"""Delimited source files: where they lie and how they are read."""

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from terratally.functions.vocabulary import SITES
from terratally.schemas import MISSION_FILE, PURCHASE_FILE


@dataclass(frozen=True)
class Drop:
    """Root folder of the source files.

    Daily files are named by a glob that spans all sites and days at once, so Spark lists
    the files itself and a day or site without one is skipped. Staff files and the impact
    catalogue must all be there.
    """

    root: str
    sites: tuple[str, ...] = SITES

    def personnel(self) -> list[str]:
        return [f"{self.root}/BDD_BGES_{site}/PERSONNEL_{site}.txt" for site in self.sites]

    def missions(self, days: str) -> str:
        return f"{self._kind_folder('MISSION')}/MISSION_{days}.txt"

    def purchases(self, days: str) -> str:
        return f"{self._kind_folder('INFORMATIQUE')}/MATERIEL_INFORMATIQUE_{days}.txt"

    def impacts(self) -> str:
        return f"{self.root}/materiel_informatique_impact.csv"

    def city_cache(self) -> str:
        return f"{self.root}/city_coordinates.json"

    def _kind_folder(self, kind: str) -> str:
        any_site = "{" + ",".join(self.sites) + "}"
        return f"{self.root}/BDD_BGES_{any_site}/BDD_BGES_{any_site}_{kind}"


def days_glob(first: date, last: date) -> str:
    """Glob for every ``yyyyMMdd`` in [first, last]; whole months become one pattern."""
    parts = []
    day = first
    while day <= last:
        next_month = (day.replace(day=1) + timedelta(days=32)).replace(day=1)
        if day.day == 1 and next_month - timedelta(days=1) <= last:
            parts.append(f"{day:%Y%m}[0-3][0-9]")
            day = next_month
        else:
            parts.append(f"{day:%Y%m%d}")
            day += timedelta(days=1)
    return "{" + ",".join(parts) + "}"


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    separator: str = ";",
    schema: StructType | None = None,
) -> DataFrame:
    """One table from any number of files with a header row; blank fields are NULL.

    With a schema the headers must agree with it, otherwise the read fails instead of
    binding columns by position.
    """
    options = {
        "header": True,
        "sep": separator,
        "encoding": "UTF-8",
        "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True,
    }
    if schema is not None:
        return spark.read.csv(paths, schema=schema, enforceSchema=False, **options)
    return spark.read.csv(paths, **options)


def read_mission_days(
    spark: SparkSession, drop: Drop, first: date, last: date
) -> DataFrame:
    """Mission files of the period; a period without a single file is an error."""
    found = _read_if_any(spark, drop.missions(days_glob(first, last)), MISSION_FILE)
    if found is None:
        raise ValueError(f"no mission file between {first} and {last} under {drop.root}")
    return found


def read_purchase_days(
    spark: SparkSession, drop: Drop, first: date, last: date
) -> DataFrame:
    """Purchase files of the period; none at all gives an empty table."""
    found = _read_if_any(spark, drop.purchases(days_glob(first, last)), PURCHASE_FILE)
    return spark.createDataFrame([], PURCHASE_FILE) if found is None else found


def _read_if_any(
    spark: SparkSession, glob: str, schema: StructType
) -> DataFrame | None:
    try:
        return read_delimited(spark, glob, schema=schema)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
