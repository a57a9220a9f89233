"""The TPC-H-like test tables seen as trips, purchases, staff, cities and a catalogue.

Orders stand for missions, line items for purchases, customers for employees, nations
for cities and parts for equipment. Joins to a parent table are left joins on its unique
key, so a view leaves out the parents a caller does not ask for.
"""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terratally.functions import vocabulary
from terratally.operators.facts import with_site, with_staff
from terratally.plans.labels import Labels
from terratally.sources.places import nautical_zone

CALENDAR_FIRST = date(1995, 1, 1)
CALENDAR_LAST = date(2001, 12, 31)
DEFAULT_MODEL = "default"

LABELS = Labels(
    paris="NATION_2",
    london="NATION_1",
    new_york="NATION_4",
    los_angeles="NATION_3",
    eu_sites=("NATION_0", "NATION_1", "NATION_2"),
    desktops=("ECONOMY%", "MEDIUM%"),
    desktop_without_screen="ECONOMY",
    laptop="STANDARD",
    screen="LARGE",
    year=1996,
)

# Columns the views use; declared, so that opening a table reads no file footer.
_LAYOUTS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_brand string, p_type string, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    ),
}

# Fixed values of the views.
_TITLE_OF_SEGMENT = {
    "AUTOMOBILE": "Cadre",
    "BUILDING": "HRD",
    "FURNITURE": "Economist",
    "HOUSEHOLD": "Data Engineer",
    "MACHINERY": "Computeringenieur",
}
_TYPE_OF_PRIORITY = {
    "1-URGENT": "Conference",
    "2-HIGH": "Schulung",
    "3-MEDIUM": "Team Meeting",
    "5-LOW": "Seminar",
}
_SITE_COUNTRIES = "array('Allemagne', 'England', 'France', 'USA', 'USA', 'China')"
_RARE_TRANSPORTS = "array('Train', 'Taxi', 'Transports en commun', 'Bateau')"


class Testbed:
    """Views over one folder of test tables; nothing is read before it is asked for."""

    __test__ = False

    labels = LABELS
    default_model = DEFAULT_MODEL

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(_LAYOUTS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def layout(self, name: str) -> str:
        return _LAYOUTS[name]

    # --- cities -------------------------------------------------------------------

    def cities(self, regions: bool = False) -> DataFrame:
        """Cities with coordinates; ``regions`` adds the raw country of non-sites."""
        nation = self.table("nation")
        country = f"get({_SITE_COUNTRIES}, n_nationkey)"
        if regions:
            nation = nation.join(
                self.table("region"), F.expr("n_regionkey = r_regionkey"), "left"
            )
            country = f"coalesce({country}, r_name)"
        return nation.select(
            F.expr("cast(n_nationkey AS bigint) AS sk_city"),
            F.expr("n_name AS city_name"),
            F.expr(f"{country} AS country_raw"),
            vocabulary.country_iso2(F.col("country_raw")).alias("country_iso2"),
            F.expr("n_nationkey < 6 AS is_org_site"),
            F.expr("if(n_nationkey < 24, 35D + 4 * (n_nationkey % 5), NULL) AS lat"),
            F.expr("if(n_nationkey < 24, -10D + 8 * (n_nationkey DIV 5), NULL) AS lon"),
        )

    # --- staff --------------------------------------------------------------------

    def staff(self, sited: bool = False) -> DataFrame:
        """Employees; ``sited`` adds the name and country of their office."""
        employees = self.table("customer").select(
            F.expr("c_custkey AS nk_staff"),
            F.expr("xxhash64(cast(c_custkey AS string)) AS sk_staff"),
            F.expr("cast(c_nationkey % 6 AS bigint) AS sk_site"),
            F.expr("date_add(DATE'1960-01-01', cast(c_custkey * 37 % 14600 AS int)) AS birth_date"),
            vocabulary.translate(F.col("c_mktsegment"), _TITLE_OF_SEGMENT).alias("title_raw"),
            vocabulary.job_title(F.col("title_raw")).alias("job_title"),
            vocabulary.activity_sector(F.col("job_title")).alias("activity_sector"),
        )
        return with_site(employees, self.cities()) if sited else employees

    def personnel(self) -> DataFrame:
        """Employees as the staff files list them, with the name of their city."""
        offices = self.cities().select(
            F.col("sk_city").alias("sk_site"), "city_name", F.col("country_raw").alias("country")
        )
        return (
            self.staff()
            .join(offices, "sk_site", "left")
            .drop("sk_site")
            .withColumns({c: F.lit(None).cast("string") for c in ("last_name", "first_name")})
        )

    def places(self) -> DataFrame:
        """City reference: coordinates and clock by city name."""
        return self.cities().where(F.col("lat").isNotNull()).select(
            "city_name", "lat", "lon", nautical_zone(F.col("lon")).alias("timezone_iana")
        )

    # --- missions -----------------------------------------------------------------

    def raw_missions(
        self, first: date | None = None, last: date | None = None
    ) -> DataFrame:
        """Missions as recorded, without the employee and hence without the origin."""
        return _between(self.table("orders"), "o_orderdate", first, last).select(
            F.expr("o_orderkey AS nk_mission"),
            F.expr("o_custkey AS nk_staff"),
            F.expr("cast(o_orderdate AS date) AS date_iso"),
            F.expr("(o_orderkey * 7 + o_custkey) % 25 AS sk_destination"),
            F.expr(
                f"coalesce(get({_RARE_TRANSPORTS}, cast(o_orderkey % 20 AS int)), "
                f"'{vocabulary.FLIGHT}') AS transport_raw"
            ),
            F.expr(
                "CASE o_orderkey % 10 WHEN 9 THEN NULL WHEN 8 THEN 'non' ELSE 'oui' END "
                "AS round_trip_raw"
            ),
            vocabulary.translate(F.col("o_orderpriority"), _TYPE_OF_PRIORITY).alias("type_raw"),
            vocabulary.mission_type(F.col("type_raw")).alias("mission_type"),
            vocabulary.is_round_trip(F.col("round_trip_raw")).alias("round_trip"),
        )

    def missions(
        self, first: date | None = None, last: date | None = None, sited: bool = False
    ) -> DataFrame:
        """Missions with their employee; every trip starts at the employee's office."""
        return with_staff(self.raw_missions(first, last), self.staff(sited)).withColumn(
            "sk_origin", F.col("sk_site")
        )

    def named_missions(
        self, first: date | None = None, last: date | None = None
    ) -> DataFrame:
        """Missions with name and country of both ends, as the daily files give them."""
        rows = self.missions(first, last)
        for end in ("origin", "destination"):
            side = self.cities(regions=True).select(
                F.col("sk_city").alias(f"sk_{end}"),
                F.col("city_name").alias(f"{end}_city"),
                F.col("country_raw").alias(f"{end}_country"),
            )
            rows = rows.join(side, f"sk_{end}", "left")
        return rows

    # --- purchases ----------------------------------------------------------------

    def purchases(
        self,
        first: date | None = None,
        last: date | None = None,
        staffed: bool = False,
        sited: bool = False,
    ) -> DataFrame:
        """Purchases; ``staffed`` adds the employee, ``sited`` the office as well."""
        items = _between(self.table("lineitem"), "l_shipdate", first, last)
        typed = items.join(
            self.table("part"), F.expr("l_partkey = p_partkey"), "left"
        ).selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber) AS nk_equipment",
            "l_orderkey",
            "cast(l_shipdate AS date) AS date_iso",
            "nullif(p_type, 'PROMO') AS type",
            "if(l_linenumber = 7, NULL, p_brand) AS model",
        )
        if not (staffed or sited):
            return typed.drop("l_orderkey")
        buyers = self.table("orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey AS nk_staff"
        )
        bought = typed.join(buyers, "l_orderkey", "left").drop("l_orderkey")
        return with_staff(bought, self.staff(sited))

    def catalogue(self) -> DataFrame:
        """Impact per (type, model), plus a default model per type."""
        both = (
            "array(if(p_brand NOT IN ('Brand#3', 'Brand#7'), struct(p_brand AS model, 4L AS share), NULL), "
            f"if(p_type <> 'SMALL', struct('{DEFAULT_MODEL}' AS model, 5L AS share), NULL))"
        )
        entries = self.table("part").where("p_type <> 'PROMO'").selectExpr(
            "p_type AS type", "p_retailprice", f"explode(filter({both}, x -> x IS NOT NULL)) AS entry"
        )
        # Mean price / share in whole cents, so neither the order of summation nor the engine matters.
        summed = entries.groupBy("type", "entry.model", "entry.share").agg(
            F.expr("sum(cast(round(p_retailprice * 100) AS bigint)) AS cents"),
            F.count("*").alias("parts"),
        )
        half_up = "(2 * cents + share * parts) DIV (2 * share * parts)"
        return summed.selectExpr("type", "model", f"{half_up} / 100D AS co2_impact_kg_ref")


def _between(
    table: DataFrame, column: str, first: date | None, last: date | None
) -> DataFrame:
    """Restrict a timestamp column to whole days in a form the Parquet scan understands."""
    bounds = []
    if first is not None:
        bounds.append(f"{column} >= TIMESTAMP_NTZ'{first}'")
    if last is not None:
        bounds.append(f"{column} < TIMESTAMP_NTZ'{last + timedelta(days=1)}'")
    return table.where(" AND ".join(bounds)) if bounds else table
