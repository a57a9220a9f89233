"""Column layouts: the delimited source files and the published star tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _text_columns(names: str) -> StructType:
    layout = StructType()
    for name in names.split():
        layout.add(name, "string", True)
    return layout


def _typed_columns(spec: str) -> StructType:
    """Parse ``name:type`` words; a trailing ``!`` marks a column that is never NULL."""
    layout = StructType()
    for word in spec.split():
        name, kind = word.split(":")
        layout.add(name, kind.rstrip("!"), not kind.endswith("!"))
    return layout


# Header names of the source files, in file order.
PERSONNEL_FILE = _text_columns(
    "ID_PERSONNEL NOM_PERSONNEL PRENOM_PERSONNEL DT_NAISS VILLE_NAISS PAYS_NAISS "
    "NUM_SECU IND_PAYS_NUM_TELP NUM_TELEPHONE NUM_VOIE DSC_VOIE CMPL_VOIE CD_POSTAL "
    "VILLE PAYS FONCTION_PERSONNEL TS_CREATION_PERSONNEL TS_MAJ_PPERSONNEL"
)
MISSION_FILE = _text_columns(
    "ID_MISSION ID_PERSONNEL NOM_PERSONNEL PRENOM_PERSONNEL DATE_MISSION TYPE_MISSION "
    "VILLE_DEPART PAYS_DEPART VILLE_DESTINATION PAYS_DESTINATION TRANSPORT ALLER_RETOUR"
)
PURCHASE_FILE = _text_columns(
    "ID_MATERIELINFO ID_PERSONNEL NOM_PERSONNEL PRENOM_PERSONNEL DATE_ACHAT TYPE MODELE"
)
IMPACT_FILE = _text_columns("Type Modèle Impact")

# The star tables. Names match whatever case a query uses.
DIM_DATE = _typed_columns("sk_date:long! date_iso:date!")
DIM_CITY = _typed_columns(
    "sk_city:long! city_name:string! country_iso2:string is_org_site:boolean! "
    "timezone_iana:string"
)
DIM_STAFF = _typed_columns(
    "sk_staff:long! nk_staff:string! last_name:string first_name:string "
    "job_title:string activity_sector:string birth_date:date sk_site:long!"
)
DIM_EQUIPMENT = _typed_columns(
    "sk_equipment:long! type:string model:string co2_impact_kg_ref:double"
)
DIM_TRANSPORT_TYPE = _typed_columns(
    "sk_transport_type:long! transport_name:string! co2_factor_kg_per_km:double!"
)
DIM_TRIP = _typed_columns(
    "sk_trip:long sk_city_origin:long sk_city_destination:long distance_km:double"
)
# The lookups behind a fact are left joins, so every key may be NULL.
FACT_MISSION = _typed_columns(
    "sk_fact_mission:long nk_mission:string sk_date_mission:long sk_staff:long "
    "sk_trip:long sk_transport_type:long mission_type:string round_trip_flg:boolean! "
    "co2_impact_kg:double"
)
FACT_EQUIPMENT = _typed_columns(
    "sk_fact_equipment:long nk_equipment:string sk_date_purchase:long sk_staff:long "
    "sk_equipment:long co2_impact_kg:double"
)


def publish(frame: DataFrame, layout: StructType, **renamed: str | Column) -> DataFrame:
    """Project ``frame`` onto ``layout``; ``renamed`` says where a column comes from."""
    picked = []
    for field in layout.fields:
        origin = renamed.get(field.name, field.name)
        column = F.col(origin) if isinstance(origin, str) else origin
        picked.append(column.cast(field.dataType).alias(field.name))
    return frame.select(*picked)
