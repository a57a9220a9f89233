"""The same answers in plain SQL, written apart from the Spark code.

Every statement starts from the views below, which say in SQL how the test tables stand
for trips, purchases, staff and cities. DuckDB runs them on the same Parquet files.
"""

_CITY = """
tb_city AS (
  SELECT CAST(n_nationkey AS BIGINT) AS sk_city, n_name AS city_name,
    CASE n_nationkey WHEN 0 THEN 'Allemagne' WHEN 1 THEN 'England' WHEN 2 THEN 'France'
      WHEN 3 THEN 'USA' WHEN 4 THEN 'USA' WHEN 5 THEN 'China' ELSE r_name END AS country_raw,
    CASE n_nationkey WHEN 0 THEN 'DE' WHEN 1 THEN 'GB' WHEN 2 THEN 'FR'
      WHEN 3 THEN 'US' WHEN 4 THEN 'US' WHEN 5 THEN 'CN' END AS country_iso2,
    n_nationkey < 6 AS is_org_site,
    CASE WHEN n_nationkey < 24
      THEN CAST(35 + 4 * (n_nationkey % 5) AS DOUBLE) END AS lat,
    CASE WHEN n_nationkey < 24
      THEN CAST(-10 + 8 * ((n_nationkey - n_nationkey % 5) // 5) AS DOUBLE) END AS lon
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

_STAFF = """
tb_staff AS (
  SELECT c_custkey AS nk_staff,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cadre' WHEN 'BUILDING' THEN 'HRD'
      WHEN 'FURNITURE' THEN 'Economist' WHEN 'HOUSEHOLD' THEN 'Data Engineer'
      WHEN 'MACHINERY' THEN 'Computeringenieur' END AS title_raw,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cadre' WHEN 'BUILDING' THEN 'DRH'
      WHEN 'FURNITURE' THEN 'Economiste' WHEN 'HOUSEHOLD' THEN 'Ingénieur Data'
      WHEN 'MACHINERY' THEN 'Ingénieur Informaticien' END AS job_title,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Management'
      WHEN 'BUILDING' THEN 'Ressources Humaines' WHEN 'FURNITURE' THEN 'Finance'
      WHEN 'HOUSEHOLD' THEN 'Informatique' WHEN 'MACHINERY' THEN 'Informatique'
      END AS activity_sector,
    CAST(c_nationkey % 6 AS BIGINT) AS sk_site,
    DATE '1960-01-01' + CAST(c_custkey * 37 % 14600 AS INTEGER) AS birth_date
  FROM customer
)"""

# Thomas' closed form of the geodesic, on every pair of cities.
_TRIP = """
spot AS (
  SELECT sk_city, atan((1 - 1 / 298.257223563) * tan(radians(lat))) AS phi,
    radians(lon) AS lam
  FROM tb_city
),
pair AS (
  SELECT o.sk_city AS sk_origin, d.sk_city AS sk_destination,
    sin((d.phi - o.phi) / 2) ** 2 AS half, sin((d.phi + o.phi) / 2) ** 2 AS mean,
    sin((d.lam - o.lam) / 2) ** 2 AS turn
  FROM spot o CROSS JOIN spot d
),
chord AS (
  SELECT sk_origin, sk_destination, half, mean,
    half + (1 - half - mean) * turn AS l
  FROM pair
),
arc AS (
  SELECT sk_origin, sk_destination, l, 2 * asin(sqrt(l)) AS d,
    CASE WHEN l > 1e-15 THEN 2 * mean * (1 - half) / (1 - l) END AS u,
    CASE WHEN l > 1e-15 THEN 2 * half * (1 - mean) / l END AS v
  FROM chord
),
term AS (
  SELECT sk_origin, sk_destination, l, sin(d) AS s, 2 * cos(d) AS e, u + v AS x, u - v AS y,
    CASE WHEN l > 1e-15 THEN d / sin(d) END AS t
  FROM arc
),
trip AS (
  SELECT sk_origin, sk_destination,
    CASE WHEN l <= 1e-15 THEN 0.0 ELSE round(6378.137 * s * (
      t - (1 / 298.257223563) / 4 * (t * x - y)
      + (1 / 298.257223563) ** 2 / 64 * (
        x * (4 * t * t * e + (t - (4 * t * t * e - e) / 2) * x)
        - y * (8 * t * t + e * y) + 4 * t * t * x * y)), 6) END AS distance_km
  FROM term
)"""

_MISSION = """
tb_mission AS (
  SELECT o_orderkey AS nk_mission, o_custkey AS nk_staff, CAST(o_orderdate AS DATE) AS date_iso,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Conférence' WHEN '2-HIGH' THEN 'Formation'
      WHEN '3-MEDIUM' THEN 'Réunion' WHEN '5-LOW' THEN 'Séminaire' END AS mission_type,
    s.sk_site AS sk_origin, (o_orderkey * 7 + o_custkey) % 25 AS sk_destination,
    CASE o_orderkey % 20 WHEN 0 THEN 'Train' WHEN 1 THEN 'Taxi'
      WHEN 2 THEN 'Transports en commun' WHEN 3 THEN 'Bateau' ELSE 'Avion' END AS transport_raw,
    CASE o_orderkey % 10 WHEN 9 THEN NULL WHEN 8 THEN 'non' ELSE 'oui' END AS round_trip_raw,
    o_orderkey % 10 < 8 AS round_trip, s.nk_staff IS NOT NULL AS staff_known,
    s.job_title, s.activity_sector, s.birth_date, s.sk_site
  FROM orders LEFT JOIN tb_staff s ON o_custkey = s.nk_staff
),
factor AS (
  SELECT * FROM (VALUES (1, 'Avion court-courrier', 0.230), (2, 'Avion long-courrier', 0.187),
    (3, 'Train', 0.006), (4, 'Taxi', 0.192), (5, 'Transports en commun', 0.029))
    AS f(sk_transport_type, transport_name, kg_per_km)
),
moded AS (
  SELECT m.*, distance_km, CASE WHEN transport_raw = 'Avion' AND distance_km < 1000
      THEN 'Avion court-courrier' WHEN transport_raw = 'Avion' AND distance_km >= 1000
      THEN 'Avion long-courrier' ELSE transport_raw END AS transport_name
  FROM tb_mission m LEFT JOIN trip USING (sk_origin, sk_destination)
),
mission AS (
  SELECT moded.*, CAST(sk_transport_type AS BIGINT) AS sk_transport_type,
    distance_km * CAST(kg_per_km AS DOUBLE)
      * (CASE WHEN round_trip THEN 2 ELSE 1 END) AS co2_kg,
    site.city_name AS site_name
  FROM moded LEFT JOIN factor USING (transport_name)
    LEFT JOIN tb_city site ON moded.sk_site = site.sk_city
)"""

_CATALOGUE = """
tb_equipment_ref AS (
  SELECT p_type AS type, p_brand AS model,
    CAST((2 * sum(CAST(round(p_retailprice * 100) AS BIGINT)) + 4 * count(*))
      // (8 * count(*)) AS DOUBLE) / 100 AS impact
  FROM part WHERE p_type <> 'PROMO' AND p_brand NOT IN ('Brand#3', 'Brand#7')
  GROUP BY ALL
  UNION ALL
  SELECT p_type, 'default',
    CAST((2 * sum(CAST(round(p_retailprice * 100) AS BIGINT)) + 5 * count(*))
      // (10 * count(*)) AS DOUBLE) / 100
  FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')
  GROUP BY ALL
),
numbered_ref AS (
  SELECT *, row_number() OVER (ORDER BY type, model) AS sk_equipment FROM tb_equipment_ref
)"""

_PURCHASE = """
tb_purchase AS (
  SELECT CAST(l_shipdate AS DATE) AS date_iso, nullif(p_type, 'PROMO') AS type,
    CASE WHEN l_linenumber <> 7 THEN p_brand END AS model,
    concat(l_orderkey, '-', l_linenumber) AS nk_equipment, o_custkey AS nk_staff,
    s.nk_staff IS NOT NULL AS staff_known,
    s.job_title, s.activity_sector, s.sk_site
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN tb_staff s ON o_custkey = s.nk_staff
),
purchase AS (
  SELECT p.*, coalesce(e.sk_equipment, f.sk_equipment) AS sk_equipment,
    CAST(coalesce(e.impact, f.impact) AS DECIMAL(18, 2)) AS co2_kg,
    CASE WHEN e.type IS NOT NULL THEN 'exact' WHEN f.type IS NOT NULL THEN 'default'
      ELSE 'none' END AS found,
    site.city_name AS site_name
  FROM tb_purchase p
    LEFT JOIN numbered_ref e ON p.type = e.type AND p.model = e.model
    LEFT JOIN numbered_ref f ON p.type = f.type AND f.model = 'default'
    LEFT JOIN tb_city site ON p.sk_site = site.sk_city
)"""

_STAFFED = f"WITH {_CITY.strip()}, {_STAFF.strip()}"
_MISSIONS = ", ".join([_STAFFED, _TRIP.strip(), _MISSION.strip()])
_PURCHASES = ", ".join([_STAFFED, _CATALOGUE.strip(), _PURCHASE.strip()])
_BOTH = ", ".join([_MISSIONS, _CATALOGUE.strip(), _PURCHASE.strip()])

_PERIOD = "date_iso BETWEEN DATE '1996-05-01' AND DATE '1996-10-31'"
_EU = "sk_site IN (0, 1, 2)"


def _round(value: str, decimals: int) -> str:
    """Half away from zero on the exact decimal, not on the nearest double."""
    return f"CAST(round(CAST({value} AS DECIMAL(28, 6)), {decimals}) AS DOUBLE)"


def _tonnes(value: str, decimals: int = 3) -> str:
    return _round(f"CAST({value} AS DOUBLE) / 1000", decimals)


def _months(first: int, last: int) -> str:
    return f"year(date_iso) = 1996 AND month(date_iso) BETWEEN {first} AND {last}"


def _total(relation: str, condition: str) -> str:
    return (
        f"SELECT coalesce({_tonnes('sum(co2_kg)')}, 0.0) AS tco2e "
        f"FROM {relation} WHERE {condition}"
    )


def _ranking(key: str, condition: str, limit: str = "") -> str:
    return f"""
SELECT {key}, {_round('kg', 1)} AS co2_kg FROM (
  SELECT {key}, sum(co2_kg) AS kg FROM mission WHERE {condition} GROUP BY ALL
  ORDER BY kg DESC NULLS LAST, {key} NULLS FIRST {limit})"""


def _sector_or_site(key: str) -> str:
    return f"""
, m AS (SELECT {key}, sum(co2_kg) AS m_kg FROM mission
  WHERE {_PERIOD} AND staff_known GROUP BY ALL),
p AS (SELECT {key}, CAST(sum(co2_kg) AS DOUBLE) AS p_kg FROM purchase
  WHERE {_PERIOD} AND staff_known GROUP BY ALL)
SELECT {key}, {_round('m_kg', 1)} AS co2_mission_kg, {_round('p_kg', 1)} AS co2_equip_kg,
  {_round('coalesce(m_kg, 0) + coalesce(p_kg, 0)', 1)} AS co2_total_kg
FROM m FULL JOIN p USING ({key})"""


_HEADS = "SELECT count(*) AS employees FROM tb_staff s JOIN tb_city c ON s.sk_site = c.sk_city"

_MODE_MONTHS = f"""
, modes AS (
  SELECT site_name, month(date_iso) AS month, transport_name, {_tonnes('sum(co2_kg)', 2)} AS tco2e
  FROM mission WHERE {_PERIOD} AND site_name IS NOT NULL AND sk_transport_type IS NOT NULL
  GROUP BY ALL)"""

_QUESTIONS = {
    "q01_managers_on_site": f"{_STAFFED} {_HEADS} WHERE job_title = 'Cadre' AND sk_site = 2",
    "q02_data_engineers_country": f"{_STAFFED} {_HEADS} "
    "WHERE job_title = 'Ingénieur Data' AND country_iso2 = 'US'",
    "q03_it_engineers": f"{_STAFFED} SELECT count(*) AS employees FROM tb_staff "
    "WHERE job_title = 'Ingénieur Informaticien'",
    "q04_desktop_count": f"{_PURCHASES} SELECT count(*) AS purchases FROM purchase "
    f"WHERE {_months(6, 9)} AND type IN ('ECONOMY', 'MEDIUM') AND found <> 'none'",
    "q05_desktop_co2": f"{_PURCHASES} {_total('purchase', _PERIOD + " AND type = 'ECONOMY'")}",
    "q06_laptops_role_sites": f"{_PURCHASES} "
    + _total(
        "purchase",
        f"{_PERIOD} AND type = 'STANDARD' AND job_title = 'Ingénieur Data' AND sk_site IN (1, 4)",
    ),
    "q07_screens_managers": f"{_PURCHASES} "
    + _total("purchase", f"{_months(7, 9)} AND type = 'LARGE' AND job_title = 'Cadre'"),
    "q08_eu_missions": f"{_MISSIONS} {_total('mission', f'{_PERIOD} AND {_EU}')}",
    "q09_top_days": _MISSIONS
    + _ranking(
        "date_iso", f"{_PERIOD} AND {_EU} AND transport_name LIKE 'Avion %'", "LIMIT 5"
    ),
    "q10_sector_total": _BOTH + _sector_or_site("activity_sector"),
    "q11_site_total": _BOTH + _sector_or_site("site_name"),
    "q12_intersite": f"{_MISSIONS} "
    + _total("mission", f"{_months(9, 9)} AND sk_origin < 6 AND sk_destination < 6"),
    "q13_seminars_site": f"{_MISSIONS} "
    + _total("mission", f"{_months(7, 7)} AND mission_type = 'Séminaire' AND sk_site = 3"),
    "q14_conference_sector": _MISSIONS
    + _ranking(
        "activity_sector", f"{_months(5, 9)} AND mission_type = 'Conférence' AND staff_known"
    ),
    "q15_avg_age": f"""{_MISSIONS}
SELECT coalesce(round(avg(year(date_iso) - year(birth_date) - CASE
    WHEN birth_date + to_years(CAST(year(date_iso) - year(birth_date) AS INTEGER)) > date_iso
    THEN 1 ELSE 0 END), 1), 0.0) AS avg_age
FROM mission WHERE {_months(7, 9)} AND mission_type = 'Formation'
  AND job_title = 'Ingénieur Data'""",
    "q16_top_destinations": f"""{_MISSIONS}
SELECT destination, {_round('kg', 1)} AS co2_kg FROM (
  SELECT c.city_name AS destination, sum(co2_kg) AS kg
  FROM mission JOIN tb_city c ON sk_destination = c.sk_city
  WHERE {_PERIOD} AND sk_origin IS NOT NULL
  GROUP BY ALL ORDER BY kg DESC NULLS LAST, destination LIMIT 5)""",
    "q17_top_mission_types": _MISSIONS
    + _ranking("mission_type", f"{_months(5, 5)} AND {_EU} AND job_title = 'Cadre'", "LIMIT 3"),
    "q18_top_missions": f"""{_MISSIONS}
SELECT nk_mission, mission_type, transport_name, {_round('co2_kg', 1)} AS co2_kg FROM (
  SELECT * FROM mission WHERE {_PERIOD} AND sk_site = 2 AND sk_transport_type IS NOT NULL
  ORDER BY mission.co2_kg DESC NULLS LAST, nk_mission LIMIT 5)""",
    "q19_monthly_transport_site": f"{_MISSIONS}{_MODE_MONTHS} SELECT * FROM modes",
    "q19_pivot": f"""{_MISSIONS}{_MODE_MONTHS}
SELECT s.site_name, t.month,
  coalesce(max(tco2e) FILTER (transport_name = 'Avion court-courrier'), 0.0) AS short_haul,
  coalesce(max(tco2e) FILTER (transport_name = 'Avion long-courrier'), 0.0) AS long_haul,
  coalesce(max(tco2e) FILTER (transport_name = 'Train'), 0.0) AS train,
  coalesce(max(tco2e) FILTER (transport_name = 'Taxi'), 0.0) AS taxi,
  coalesce(max(tco2e) FILTER (transport_name = 'Transports en commun'), 0.0) AS public_transport
FROM (SELECT DISTINCT site_name FROM modes) s CROSS JOIN (SELECT DISTINCT month FROM modes) t
  LEFT JOIN modes ON modes.site_name = s.site_name AND modes.month = t.month
GROUP BY ALL""",
    "q20_monthly_total": f"""{_BOTH}
, m AS (SELECT month(date_iso) AS month, {_tonnes('sum(co2_kg)', 2)} AS tm
  FROM mission WHERE {_PERIOD} GROUP BY ALL),
p AS (SELECT month(date_iso) AS month, {_tonnes('sum(co2_kg)', 2)} AS tp
  FROM purchase WHERE {_PERIOD} GROUP BY ALL)
SELECT month, coalesce(tm, 0.0) AS tco2e_missions, coalesce(tp, 0.0) AS tco2e_equipements,
  round(coalesce(tm, 0.0) + coalesce(tp, 0.0), 2) AS tco2e_total
FROM m FULL JOIN p USING (month)""",
}

_CLOCK = """CASE WHEN round(lon / 15) > 0 THEN 'Etc/GMT-' || CAST(round(lon / 15) AS INTEGER)
    WHEN round(lon / 15) < 0 THEN 'Etc/GMT+' || CAST(-round(lon / 15) AS INTEGER)
    WHEN lon IS NOT NULL THEN 'Etc/GMT' END"""

_AUGMENTED = f"""{_MISSIONS}
, sites AS (
  SELECT row_number() OVER (ORDER BY city_name) AS sk_city, city_name, country_iso2,
    TRUE AS is_org_site, {_CLOCK} AS timezone_iana, lat, lon
  FROM tb_city WHERE sk_city IN (SELECT sk_site FROM tb_staff)
),
visited AS (
  SELECT DISTINCT city_name, country_iso2, lat, lon FROM tb_city
  WHERE sk_city IN (SELECT sk_origin FROM tb_mission UNION SELECT sk_destination FROM tb_mission)
),
augmented AS (
  SELECT * FROM sites
  UNION ALL
  SELECT (SELECT max(sk_city) FROM sites) + row_number() OVER (ORDER BY city_name),
    city_name, country_iso2, FALSE, {_CLOCK}, lat, lon
  FROM visited WHERE city_name NOT IN (SELECT city_name FROM sites)
)"""

_PAIRS = f"""{_MISSIONS}
, dim_trip AS (
  SELECT sk_origin * 4294967296 + sk_destination AS sk_trip, sk_origin AS sk_city_origin,
    sk_destination AS sk_city_destination, distance_km
  FROM (SELECT DISTINCT sk_origin, sk_destination FROM tb_mission)
    LEFT JOIN trip USING (sk_origin, sk_destination)
)"""

_FIRST_DAY = """(SELECT CAST(date_trunc('year', least(
  (SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem))) AS DATE))"""
_DAY_NUMBER = f"CAST(date_diff('day', {_FIRST_DAY}, date_iso) + 1 AS BIGINT)"


def _profile(relation: str, key: str, name: str) -> str:
    return f"SELECT {key}, count(*) AS {name} FROM {relation} GROUP BY ALL"


def _described(table: str, relation: str, columns: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {relation}) AS row_count, "
        f"'{columns}' AS column_list"
    )


def _repeated(table: str, relation: str, key: str, condition: str = "TRUE") -> str:
    return f"""
SELECT '{table}' AS table_name, count(*) AS keys,
  count(*) FILTER (n > 1) AS repeated
FROM (SELECT {key}, count(*) AS n FROM {relation} WHERE {condition} GROUP BY ALL)"""


_OPERATORS = {
    "scan_date_window": f"{_MISSIONS} SELECT date_iso, sk_site, count(*) AS missions "
    f"FROM tb_mission WHERE {_PERIOD} GROUP BY ALL",
    "table_counts": f"{_PURCHASES}, {_TRIP.strip()}, {_MISSION.strip()} "
    + " UNION ALL ".join(
        [
            _described(
                "dim_date",
                """(SELECT unnest(generate_series(date_trunc('year', least(
                  (SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem))),
                  date_trunc('year', greatest((SELECT max(o_orderdate) FROM orders),
                  (SELECT max(l_shipdate) FROM lineitem))) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                  INTERVAL 1 DAY)))""",
                "sk_date, date_iso",
            ),
            _described(
                "dim_staff",
                "tb_staff",
                "sk_staff, nk_staff, last_name, first_name, job_title, activity_sector, "
                "birth_date, sk_site",
            ),
            _described(
                "dim_equipment", "tb_equipment_ref", "sk_equipment, type, model, co2_impact_kg_ref"
            ),
            _described(
                "dim_transport_type",
                "factor",
                "sk_transport_type, transport_name, co2_factor_kg_per_km",
            ),
            _described(
                "dim_city",
                "(SELECT sk_origin FROM tb_mission UNION SELECT sk_destination FROM tb_mission)",
                "sk_city, city_name, country_iso2, is_org_site, timezone_iana",
            ),
            _described(
                "dim_trip",
                "(SELECT DISTINCT sk_origin, sk_destination FROM tb_mission)",
                "sk_trip, sk_city_origin, sk_city_destination, distance_km",
            ),
            _described(
                "fact_mission",
                "tb_mission",
                "sk_fact_mission, nk_mission, sk_date_mission, sk_staff, sk_trip, "
                "sk_transport_type, mission_type, round_trip_flg, co2_impact_kg",
            ),
            _described(
                "fact_equipment",
                "tb_purchase",
                "sk_fact_equipment, nk_equipment, sk_date_purchase, sk_staff, sk_equipment, "
                "co2_impact_kg",
            ),
        ]
    ),
    "incremental_missing_dates": f"""
SELECT date_iso, count(*) AS missions
FROM (SELECT CAST(o_orderdate AS DATE) AS date_iso FROM orders)
WHERE date_iso NOT IN (
  SELECT CAST(o_orderdate AS DATE) AS date_iso FROM orders WHERE {_PERIOD})
GROUP BY ALL""",
    "warehouse_days": f"""{_MISSIONS}
SELECT date_iso, count(*) AS missions, {_round('sum(co2_kg)', 3)} AS co2_kg
FROM mission WHERE {_months(9, 9)} AND day(date_iso) >= 16 GROUP BY ALL""",
    "dim_date": """
SELECT row_number() OVER (ORDER BY d) AS sk_date, CAST(d AS DATE) AS date_iso
FROM (SELECT unnest(generate_series(
    date_trunc('year', min(first)), date_trunc('year', max(last)) + INTERVAL 1 YEAR
    - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
  FROM (SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders
    UNION ALL SELECT min(l_shipdate), max(l_shipdate) FROM lineitem))""",
    "dim_transport_type": f"""{_MISSIONS}
SELECT CAST(f.sk_transport_type AS BIGINT) AS sk_transport_type, f.transport_name,
  CAST(kg_per_km AS DOUBLE) AS co2_factor_kg_per_km, count(m.nk_mission) AS missions
FROM factor f LEFT JOIN mission m ON f.transport_name = m.transport_name GROUP BY ALL""",
    "dim_equipment": f"WITH {_CATALOGUE.strip()} SELECT sk_equipment, type, model, "
    "impact AS co2_impact_kg_ref FROM numbered_ref",
    "dim_city_sites": f"{_AUGMENTED} SELECT sk_city, city_name, country_iso2, is_org_site, "
    "timezone_iana FROM sites",
    "dim_city_augmented": f"{_AUGMENTED} SELECT * FROM augmented",
    "dim_staff": f"""{_AUGMENTED}
SELECT CAST(nk_staff AS VARCHAR) AS nk_staff, job_title, activity_sector, birth_date,
  s.sk_city AS sk_site
FROM tb_staff JOIN tb_city c ON sk_site = c.sk_city JOIN sites s ON c.city_name = s.city_name""",
    "dim_trip": f"{_PAIRS} SELECT * REPLACE ({_round('distance_km', 3)} AS distance_km) "
    "FROM dim_trip",
    "fact_mission": f"""{_MISSIONS}
SELECT CAST(nk_mission AS VARCHAR) AS nk_mission, {_DAY_NUMBER} AS sk_date_mission,
  sk_origin * 4294967296 + sk_destination AS sk_trip, sk_transport_type, mission_type,
  coalesce(round_trip, FALSE) AS round_trip_flg, {_round('co2_kg', 3)} AS co2_impact_kg
FROM mission""",
    "transport_haul_split": f"""{_MISSIONS}
SELECT transport_name, count(*) AS missions, {_round('min(distance_km)', 3)} AS shortest_km,
  {_round('max(distance_km)', 3)} AS longest_km
FROM mission GROUP BY ALL""",
    "mission_co2": f"""{_MISSIONS}
SELECT nk_mission, {_round('distance_km', 3)} AS distance_km,
  CAST(kg_per_km AS DOUBLE) AS co2_factor, {_round('co2_kg', 3)} AS co2_kg
FROM mission LEFT JOIN factor USING (transport_name)""",
    "fact_equipment": f"""{_PURCHASES}
SELECT nk_equipment, {_DAY_NUMBER} AS sk_date_purchase, sk_equipment,
  CAST(co2_kg AS DOUBLE) AS co2_impact_kg FROM purchase""",
    "equipment_co2_lookup": f"""{_PURCHASES}
SELECT type, found, count(*) AS purchases, CAST(sum(co2_kg) AS DOUBLE) AS co2_kg
FROM purchase GROUP BY ALL""",
    "mission_mart": f"""{_MISSIONS}
SELECT nk_mission, nk_staff, date_iso, year(date_iso) AS year, month(date_iso) AS month,
  day(date_iso) AS day, mission_type, coalesce(round_trip, FALSE) AS round_trip, job_title,
  activity_sector, birth_date, site_name, transport_name, sk_origin, sk_destination,
  d.city_name AS destination_city_name, {_round('distance_km', 3)} AS distance_km,
  {_round('co2_kg', 3)} AS co2_kg
FROM mission JOIN tb_city d ON sk_destination = d.sk_city
WHERE sk_transport_type IS NOT NULL AND site_name IS NOT NULL""",
    "equipment_mart": f"""{_PURCHASES}
SELECT nk_equipment, nk_staff, date_iso, year(date_iso) AS year, month(date_iso) AS month,
  day(date_iso) AS day, job_title, activity_sector, site_name, type,
  CAST(co2_kg AS DOUBLE) AS co2_kg
FROM purchase WHERE found <> 'none' AND site_name IS NOT NULL""",
    "join_semi_staff": f"""{_MISSIONS}
SELECT month(date_iso) AS month, count(*) AS missions FROM tb_mission
WHERE nk_staff IN (SELECT nk_staff FROM tb_staff WHERE job_title = 'Cadre') GROUP BY ALL""",
    "join_inner_site": f"""{_MISSIONS}
SELECT site_name, activity_sector, count(*) AS missions FROM mission
WHERE site_name IS NOT NULL GROUP BY ALL""",
    "join_left_dims": f"""{_MISSIONS}
SELECT transport_raw, count(*) AS missions,
  count(date_iso) AS with_date,
  count(*) FILTER (staff_known) AS with_staff, count(sk_origin) AS with_origin,
  count(sk_transport_type) AS with_mode
FROM mission GROUP BY ALL""",
    "join_left_trip": f"""{_PAIRS}
SELECT nk_mission, sk_city_origin, sk_city_destination, sk_trip,
  {_round('distance_km', 3)} AS distance_km
FROM (SELECT nk_mission, sk_origin AS sk_city_origin, sk_destination AS sk_city_destination
    FROM tb_mission) LEFT JOIN dim_trip USING (sk_city_origin, sk_city_destination)""",
    "star_fact_mission": f"""{_MISSIONS}
SELECT CAST(nk_mission AS VARCHAR) AS nk_mission, {_DAY_NUMBER} AS sk_date_mission,
  o.city_name AS origin_city, d.city_name AS destination_city, sk_transport_type, mission_type,
  coalesce(round_trip, FALSE) AS round_trip_flg, {_round('co2_kg', 3)} AS co2_impact_kg
FROM mission LEFT JOIN tb_city o ON sk_origin = o.sk_city
  LEFT JOIN tb_city d ON sk_destination = d.sk_city""",
    "star_keys": f"""{_PURCHASES}
SELECT 'dim_staff' AS table_name, count(DISTINCT c_custkey) AS natural_keys,
  count(DISTINCT c_custkey) AS surrogate_keys, CAST(1 AS BIGINT) AS most_per_natural_key
FROM customer
UNION ALL
SELECT 'fact_mission', count(DISTINCT o_orderkey), count(DISTINCT o_orderkey), 1 FROM orders
UNION ALL
SELECT 'fact_equipment', count(DISTINCT nk_equipment), count(DISTINCT nk_equipment), 1
FROM tb_purchase""",
    "distinct_trips": f"""{_MISSIONS}
SELECT DISTINCT o.city_name AS origin_city, d.city_name AS destination_city
FROM tb_mission LEFT JOIN tb_city o ON sk_origin = o.sk_city
  LEFT JOIN tb_city d ON sk_destination = d.sk_city""",
    "union_distinct_cities": f"""{_MISSIONS}
SELECT city_name, country_raw AS country FROM tb_mission JOIN tb_city ON sk_origin = sk_city
UNION
SELECT city_name, country_raw FROM tb_mission JOIN tb_city ON sk_destination = sk_city""",
    "map_lookup_titles": f"{_STAFFED} "
    + _profile("tb_staff", "title_raw, job_title, activity_sector", "employees"),
    "round_trip_flag": f"{_MISSIONS} "
    + _profile(
        "tb_mission",
        "round_trip_raw, coalesce(round_trip_raw = 'oui', FALSE) AS round_trip",
        "missions",
    ),
    "surrogate_trip_key": f"{_MISSIONS} "
    + _profile("tb_mission", "sk_origin * 4294967296 + sk_destination AS sk_trip", "missions"),
    "country_iso2_lookup": f"{_MISSIONS} "
    + _profile(
        "tb_mission JOIN tb_city ON sk_destination = sk_city",
        "country_raw, country_iso2",
        "missions",
    ),
    "city_reference_lookup": f"{_MISSIONS} "
    + _profile(
        "tb_mission JOIN tb_city ON sk_destination = sk_city",
        f"city_name, lat, lon, {_CLOCK} AS timezone_iana",
        "missions",
    ),
    "trip_distance": f"""{_MISSIONS}
SELECT sk_origin, sk_destination, {_round('max(distance_km)', 3)} AS distance_km,
  {_round('count(*) * max(distance_km)', 2)} AS total_km
FROM mission GROUP BY ALL""",
    "staff_by_title": f"{_STAFFED} {_profile('tb_staff', 'job_title', 'employees')}",
    "staff_by_sector": f"{_STAFFED} {_profile('tb_staff', 'activity_sector', 'employees')}",
    "staff_by_site": f"{_STAFFED} {_profile('tb_staff', 'sk_site', 'employees')}",
    "missions_by_type": f"{_MISSIONS} {_profile('tb_mission', 'mission_type', 'missions')}",
    "city_counts": f"{_AUGMENTED} SELECT count(*) AS cities, "
    "count(*) FILTER (is_org_site) AS org_sites FROM augmented",
    "dq_city_no_country": f"{_AUGMENTED} SELECT city_name FROM augmented "
    "WHERE country_iso2 IS NULL",
    "longest_trips": f"""{_PAIRS}
SELECT * REPLACE ({_round('distance_km', 3)} AS distance_km) FROM (
  SELECT * FROM dim_trip ORDER BY distance_km DESC NULLS LAST, sk_trip LIMIT 10)""",
    "dq_trip_no_distance": f"{_PAIRS} SELECT count(*) AS trips, "
    "count(*) - count(distance_km) AS without_distance FROM dim_trip",
    "total_mission_co2": f"{_MISSIONS} SELECT count(*) AS missions, "
    f"coalesce({_tonnes('sum(co2_kg)', 2)}, 0.0) AS tco2e FROM mission",
    "dq_mission_no_co2": f"{_MISSIONS} SELECT mission_type, count(*) AS missions "
    "FROM mission WHERE co2_kg IS NULL GROUP BY ALL",
    "total_equipment_co2": f"{_PURCHASES} SELECT count(*) AS purchases, "
    f"coalesce({_tonnes('sum(co2_kg)', 2)}, 0.0) AS tco2e FROM purchase",
    "dq_equipment_no_co2": f"{_PURCHASES} SELECT type, count(*) AS purchases "
    "FROM purchase WHERE co2_kg IS NULL GROUP BY ALL",
    "dq_key_uniqueness": _PURCHASES
    + " UNION ALL ".join(
        [
            _repeated("dim_staff", "tb_staff", "nk_staff"),
            _repeated("dim_city", "tb_city", "city_name"),
            _repeated("dim_equipment", "tb_equipment_ref", "type, model"),
            _repeated(
                "dim_equipment default", "tb_equipment_ref", "type", "model = 'default'"
            ),
            _repeated("fact_mission", "orders", "o_orderkey"),
            _repeated("fact_equipment", "lineitem", "l_orderkey, l_linenumber"),
        ]
    ),
    "stream_daily_totals": f"""{_STAFFED}
SELECT CAST(ts AS DATE) AS day, activity_sector, count(*) AS purchases,
  {_round('sum(value)', 2)} AS value
FROM events JOIN tb_staff ON user_id = nk_staff WHERE event_type = 'purchase' GROUP BY ALL""",
}

# The same tables and answers by the loads' own code, and over a star saved in two halves.
_LOADED = {
    "star_fact_equipment": _OPERATORS["fact_equipment"],
    "warehouse_two_loads": f"""
SELECT 'screens' AS label, tco2e AS amount FROM ({_QUESTIONS["q07_screens_managers"]})
UNION ALL
SELECT destination, co2_kg FROM ({_QUESTIONS["q16_top_destinations"]})""",
}

ORACLE: dict[str, str] = {**_QUESTIONS, **_OPERATORS, **_LOADED}
