"""Closed vocabularies of the domain and the columns that translate into them."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Office sites and their groups.
SITES = ("PARIS", "BERLIN", "LONDON", "NEWYORK", "LOSANGELES", "SHANGHAI")
EU_CITIES = ("Paris", "Berlin", "London")

# Job titles as spelled in the staff files -> label.
JOB_TITLES = {
    "Cadre": "Cadre",
    "DRH": "DRH",
    "Economiste": "Economiste",
    "Ingénieur Data": "Ingénieur Data",
    "Ingénieur Informaticien": "Ingénieur Informaticien",
    "Führungskraft": "Cadre",
    "Personalleiter": "DRH",
    "Ökonom": "Economiste",
    "Dateningenieur": "Ingénieur Data",
    "Computeringenieur": "Ingénieur Informaticien",
    "Business Executive": "Cadre",
    "HRD": "DRH",
    "Economist": "Economiste",
    "Data Engineer": "Ingénieur Data",
    "Computer Engineer": "Ingénieur Informaticien",
    "Manager": "Cadre",
    "HR Director": "DRH",
    "IT Engineer": "Ingénieur Informaticien",
}

# Label of a job title -> sector of activity.
SECTORS = {
    "Cadre": "Management",
    "DRH": "Ressources Humaines",
    "Economiste": "Finance",
    "Ingénieur Data": "Informatique",
    "Ingénieur Informaticien": "Informatique",
}

# Mission types as spelled in the daily files -> label.
MISSION_TYPES = {
    "Conférence": "Conférence",
    "Développement": "Développement",
    "Formation": "Formation",
    "Rencontre entreprises": "Rencontre entreprises",
    "Réunion": "Réunion",
    "Séminaire": "Séminaire",
    "Entwicklung": "Développement",
    "Geschäftstreffen": "Rencontre entreprises",
    "Konferenz": "Conférence",
    "Meeting": "Réunion",
    "Schulung": "Formation",
    "Business Meeting": "Rencontre entreprises",
    "Conference": "Conférence",
    "Development": "Développement",
    "Team Meeting": "Réunion",
    "Vocational Training": "Formation",
    "Seminar": "Séminaire",
    "Business meeting": "Rencontre entreprises",
    "Training": "Formation",
}

# Transport modes in key order -> kg CO2e per km.
EMISSION_FACTORS = {
    "Avion court-courrier": 0.230,
    "Avion long-courrier": 0.187,
    "Train": 0.006,
    "Taxi": 0.192,
    "Transports en commun": 0.029,
}
FLIGHT = "Avion"
SHORT_HAUL = "Avion court-courrier"
LONG_HAUL = "Avion long-courrier"
LONG_HAUL_FROM_KM = 1000

# Return flags that mean "there and back", and the catch-all model label.
RETURN_FLAGS = ("oui", "yes", "ja", "1")
DEFAULT_MODEL = "modèle par défaut"

# Country spellings -> ISO 3166-1 alpha-2.
COUNTRIES = {
    "Algeria": "DZ",
    "Algérie": "DZ",
    "Allemagne": "DE",
    "Deutschland": "DE",
    "Germany": "DE",
    "Argentina": "AR",
    "Argentine": "AR",
    "Australia": "AU",
    "Australie": "AU",
    "Brazil": "BR",
    "Brésil": "BR",
    "Canada": "CA",
    "China": "CN",
    "Chine": "CN",
    "Colombia": "CO",
    "Colombie": "CO",
    "Emirats": "AE",
    "Emirats Arabes Unis": "AE",
    "United Arab Emirates": "AE",
    "England": "GB",
    "Angleterre": "GB",
    "Royaume-Uni": "GB",
    "United Kingdom": "GB",
    "UK": "GB",
    "Finlande": "FI",
    "Finland": "FI",
    "France": "FR",
    "Japan": "JP",
    "Japon": "JP",
    "Maroc": "MA",
    "Morocco": "MA",
    "Mexico": "MX",
    "Mexique": "MX",
    "New Zealand": "NZ",
    "Nouvelle-Zélande": "NZ",
    "Norvège": "NO",
    "Norway": "NO",
    "Peru": "PE",
    "Pérou": "PE",
    "Suède": "SE",
    "Sweden": "SE",
    "Tunisie": "TN",
    "Tunisia": "TN",
    "USA": "US",
    "Etats-Unis": "US",
    "United States": "US",
}


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def translate(value: Column, mapping: Mapping[str, str]) -> Column:
    """Literal map lookup; unknown and NULL values give NULL, an empty map too."""
    if not mapping:
        return F.lit(None).cast("string")
    entries = ", ".join(sql_text(part) for entry in mapping.items() for part in entry)
    return F.expr(f"map({entries})")[value]


def job_title(spelling: Column) -> Column:
    return translate(spelling, JOB_TITLES)


def activity_sector(title: Column) -> Column:
    return translate(title, SECTORS)


def mission_type(spelling: Column) -> Column:
    return translate(spelling, MISSION_TYPES)


def country_iso2(spelling: Column) -> Column:
    return translate(spelling, COUNTRIES)


def is_round_trip(flag: Column) -> Column:
    return F.coalesce(flag.isin(*RETURN_FLAGS), F.lit(False))


def is_default_model(model: Column, label: str = DEFAULT_MODEL) -> Column:
    return F.lower(F.trim(model)) == F.lit(label.lower())
