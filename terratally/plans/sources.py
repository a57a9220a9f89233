"""What a question needs to know about the data, whoever provides it."""

from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame

from terratally.plans.labels import Labels


class Source(Protocol):
    """Row-level views; rows that already carry ``co2_kg`` are not priced again."""

    labels: Labels
    default_model: str

    def cities(self) -> DataFrame: ...

    def catalogue(self) -> DataFrame: ...

    def staff(self, sited: bool = False) -> DataFrame: ...

    def missions(
        self, first: date | None = None, last: date | None = None, sited: bool = False
    ) -> DataFrame: ...

    def purchases(
        self,
        first: date | None = None,
        last: date | None = None,
        staffed: bool = False,
        sited: bool = False,
    ) -> DataFrame: ...
