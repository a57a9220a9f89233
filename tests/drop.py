"""A small drop in the layout of the source files, with the awkward rows in it."""

from pathlib import Path

PERSONNEL_HEADER = (
    "ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;DT_NAISS;VILLE_NAISS;PAYS_NAISS;NUM_SECU;"
    "IND_PAYS_NUM_TELP;NUM_TELEPHONE;NUM_VOIE;DSC_VOIE;CMPL_VOIE;CD_POSTAL;VILLE;PAYS;"
    "FONCTION_PERSONNEL;TS_CREATION_PERSONNEL;TS_MAJ_PPERSONNEL"
)
MISSION_HEADER = (
    "ID_MISSION;ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;DATE_MISSION;TYPE_MISSION;"
    "VILLE_DEPART;PAYS_DEPART;VILLE_DESTINATION;PAYS_DESTINATION;TRANSPORT;ALLER_RETOUR"
)
PURCHASE_HEADER = (
    "ID_MATERIELINFO;ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;DATE_ACHAT;TYPE;MODELE"
)

# The mission of this id carries a date nobody can read.
UNDATED = "M14"

# site, id, birth, city, country, title
STAFF = [
    ("PARIS", "P1", "1980-02-29", "Paris", "France", "Cadre"),
    ("PARIS", "P2", "1990-06-15", "Paris", "France", "Ingénieur Data"),
    ("PARIS", "P3", "not a date", "Paris", "France", "Astronaute"),
    ("BERLIN", "B1", "1975-01-01", "Berlin", "Allemagne", "Führungskraft"),
    ("LONDON", "L1", "1985-12-31", "London", "England", "Data Engineer"),
    ("NEWYORK", "N1", "1992-07-04", "New-York", "USA", "Computer Engineer"),
    ("LOSANGELES", "A1", "1988-03-03", "Los Angeles", "USA", "HRD"),
    ("SHANGHAI", "S1", "1979-09-09", "Shanghai", "China", "Economist"),
    ("SHANGHAI", "S2", "1979-09-09", "", "", "Economist"),
]

# site, day, id, staff, type, from, country, to, country, transport, return flag
MISSIONS = [
    ("PARIS", "20260501", "M01", "P1", "Conférence", "Paris", "France", "Berlin", "Allemagne", "Avion", "oui"),
    ("PARIS", "20260501", "M02", "P1", "Réunion", "Paris", "France", "New-York", "USA", "Avion", "non"),
    ("PARIS", "20260703", "M03", "P2", "Formation", "Paris", "France", "Lille", "France", "Train", "yes"),
    ("PARIS", "20260703", "M04", "P2", "Formation", "Paris", "France", "Atlantis", "Nowhere", "Avion", "oui"),
    ("PARIS", "20260703", "M05", "P3", "Promenade", "Paris", "France", "Lille", "France", "Bateau", "ja"),
    ("BERLIN", "20260515", "M06", "B1", "Schulung", "Berlin", "Allemagne", "Shanghai", "China", "Avion", "1"),
    ("BERLIN", "20260902", "M07", "B1", "Konferenz", "Berlin", "Allemagne", "Paris", "France", "Avion", ""),
    ("BERLIN", "20260902", "M08", "B1", "Geschäftstreffen", "Berlin", "Allemagne", "Berlin", "Allemagne", "Taxi", "oui"),
    ("LONDON", "20260902", "M09", "L1", "Vocational Training", "London", "England", "Paris", "France", "", "oui"),
    ("LOSANGELES", "20260710", "M10", "A1", "Seminar", "Los Angeles", "USA", "New-York", "USA", "Avion", "oui"),
    ("NEWYORK", "20260710", "M11", "??", "Team Meeting", "New-York", "USA", "London", "England", "Avion", "oui"),
    ("SHANGHAI", "20261031", "M12", "S1", "Development", "Shanghai", "China", "Tokyo", "Japan", "Transports en commun", "oui"),
    ("SHANGHAI", "20261031", "M14", "S1", "Meeting", "Shanghai", "China", "Tokyo", "Japan", "Train", "non"),
    # Outside the period of the questions.
    ("PARIS", "20261105", "M13", "P1", "Conférence", "Paris", "France", "Berlin", "Allemagne", "Avion", "oui"),
]

# site, day, id, staff, type, model
PURCHASES = [
    ("PARIS", "20260601", "E01", "P1", "PC portable", "OMEN "),
    ("PARIS", "20260601", "E02", "P1", "PC portable", "no such model"),
    ("PARIS", "20260715", "E03", "P1", "Ecran", ""),
    ("BERLIN", "20260715", "E04", "B1", "Serveur", "Modèle par défaut"),
    ("BERLIN", "20260715", "E05", "B1", "", "OMEN"),
    ("LONDON", "20260810", "E06", "L1", "PC portable", "ProBook"),
    ("LONDON", "20260810", "E07", "L1", "PC fixe sans ecran", "tower"),
    ("NEWYORK", "20260810", "E08", "??", "PC fixe tout-en-un", "all in one"),
    ("SHANGHAI", "20261030", "E09", "S1", "Tablette", "slate"),
]

IMPACTS = """Type,Modèle,Impact
PC portable,OMEN,300.5
PC portable,modèle par défaut,250
PC portable,ProBook,
Ecran,modèle par défaut,120
Serveur,Modèle par défaut,900
PC fixe sans ecran,tower,180.25
PC fixe tout-en-un,all in one,n/a
"""


def write_drop(root: Path, missions=MISSIONS, purchases=PURCHASES) -> None:
    _write_staff(root)
    write_missions(root, missions)
    write_purchases(root, purchases)
    (root / "materiel_informatique_impact.csv").write_text(IMPACTS, encoding="utf-8")


def _write_staff(root: Path) -> None:
    by_site: dict[str, list[str]] = {}
    for site, key, birth, city, country, title in STAFF:
        line = f"{key};Last {key};First {key};{birth};;;;;;;;;;{city};{country};{title};;"
        by_site.setdefault(site, []).append(line)
    for site, lines in by_site.items():
        _write(root / f"BDD_BGES_{site}" / f"PERSONNEL_{site}.txt", PERSONNEL_HEADER, lines)


def write_missions(root: Path, missions) -> None:
    files: dict[Path, list[str]] = {}
    for site, day, key, staff, kind, *rest in missions:
        path = root / f"BDD_BGES_{site}" / f"BDD_BGES_{site}_MISSION" / f"MISSION_{day}.txt"
        stamp = f"{day[:4]}-{day[4:6]}-{day[6:]} 08:30:00" if key != UNDATED else "gestern"
        files.setdefault(path, []).append(
            ";".join([key, staff, "Last", "First", stamp, kind, *rest])
        )
    for path, lines in files.items():
        _write(path, MISSION_HEADER, lines)


def write_purchases(root: Path, purchases) -> None:
    files: dict[Path, list[str]] = {}
    for site, day, key, staff, kind, model in purchases:
        folder = root / f"BDD_BGES_{site}" / f"BDD_BGES_{site}_INFORMATIQUE"
        stamp = f"{day[:4]}-{day[4:6]}-{day[6:]} 17:00:00"
        files.setdefault(folder / f"MATERIEL_INFORMATIQUE_{day}.txt", []).append(
            ";".join([key, staff, "Last", "First", stamp, kind, model])
        )
    for path, lines in files.items():
        _write(path, PURCHASE_HEADER, lines)


def _write(path: Path, header: str, lines: list[str]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
