"""The names a question refers to: sites, equipment kinds and the year."""

from dataclasses import dataclass
from datetime import date, timedelta

from terratally.functions import vocabulary


@dataclass(frozen=True)
class Labels:
    """Fixed values as they stand in the source files; a testbed brings its own."""

    paris: str = "Paris"
    london: str = "London"
    new_york: str = "New-York"
    los_angeles: str = "Los Angeles"
    eu_sites: tuple[str, ...] = vocabulary.EU_CITIES
    us_country: str = "US"
    managers: str = "Cadre"
    data_engineers: str = "Ingénieur Data"
    it_engineers: str = "Ingénieur Informaticien"
    desktops: tuple[str, ...] = ("PC fixe%",)
    desktop_without_screen: str = "PC fixe sans ecran"
    laptop: str = "PC portable"
    screen: str = "Ecran"
    seminar: str = "Séminaire"
    conference: str = "Conférence"
    training: str = "Formation"
    year: int = 2026
    first_month: int = 5
    last_month: int = 10

    def months(self, first: int, last: int) -> tuple[date, date]:
        """First and last day of a range of months."""
        start_of_next = (date(self.year, last, 1) + timedelta(days=32)).replace(day=1)
        return date(self.year, first, 1), start_of_next - timedelta(days=1)

    @property
    def period(self) -> tuple[date, date]:
        """The whole period the questions look at."""
        return self.months(self.first_month, self.last_month)
