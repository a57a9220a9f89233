"""City reference: where a city lies and which clock it keeps.

Takes the place of online geocoding and time-zone polygons. The built-in list holds the
cities of the shipped drops; a ``city_coordinates.json`` cache (city -> [lat, lon] or
null) adds to it or overrides it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# City, latitude, longitude, IANA time zone (public geography).
CITIES = (
    ("Alger", 36.7538, 3.0588, "Africa/Algiers"),
    ("Auckland", -36.8509, 174.7645, "Pacific/Auckland"),
    ("Berlin", 52.5200, 13.4050, "Europe/Berlin"),
    ("Bogota", 4.7110, -74.0721, "America/Bogota"),
    ("Bordeaux", 44.8378, -0.5792, "Europe/Paris"),
    ("Buenos Aires", -34.6037, -58.3816, "America/Argentina/Buenos_Aires"),
    ("Compiègne", 49.4179, 2.8261, "Europe/Paris"),
    ("Dubaï", 25.2048, 55.2708, "Asia/Dubai"),
    ("Helsinki", 60.1699, 24.9384, "Europe/Helsinki"),
    ("Lille", 50.6292, 3.0573, "Europe/Paris"),
    ("Lima", -12.0464, -77.0428, "America/Lima"),
    ("London", 51.5074, -0.1278, "Europe/London"),
    ("Los Angeles", 34.0522, -118.2437, "America/Los_Angeles"),
    ("Marseille", 43.2965, 5.3698, "Europe/Paris"),
    ("Melbourne", -37.8136, 144.9631, "Australia/Melbourne"),
    ("Mexico", 19.4326, -99.1332, "America/Mexico_City"),
    ("Montreal", 45.5017, -73.5673, "America/Toronto"),
    ("New-York", 40.7128, -74.0060, "America/New_York"),
    ("Osaka", 34.6937, 135.5023, "Asia/Tokyo"),
    ("Oslo", 59.9139, 10.7522, "Europe/Oslo"),
    ("Paris", 48.8566, 2.3522, "Europe/Paris"),
    ("Pekin", 39.9042, 116.4074, "Asia/Shanghai"),
    ("Rabat", 34.0209, -6.8416, "Africa/Casablanca"),
    ("Rio de Janeiro", -22.9068, -43.1729, "America/Sao_Paulo"),
    ("Sao Paulo", -23.5505, -46.6333, "America/Sao_Paulo"),
    ("Shanghai", 31.2304, 121.4737, "Asia/Shanghai"),
    ("Sidney", -33.8688, 151.2093, "Australia/Sydney"),
    ("Stockholm", 59.3293, 18.0686, "Europe/Stockholm"),
    ("Tokyo", 35.6762, 139.6503, "Asia/Tokyo"),
    ("Tunis", 36.8065, 10.1815, "Africa/Tunis"),
    ("Vancouver", 49.2827, -123.1207, "America/Vancouver"),
    ("Washington", 38.9072, -77.0369, "America/New_York"),
    ("Wellington", -41.2866, 174.7756, "Pacific/Auckland"),
)
_LAYOUT = "city_name string, lat double, lon double, timezone_iana string"


def nautical_zone(longitude: Column) -> Column:
    """``Etc/GMT`` zone of a longitude; the sign in the name runs against the offset."""
    hours = F.round(longitude / 15).cast("int")
    return (
        F.when(hours > 0, F.concat(F.lit("Etc/GMT-"), hours.cast("string")))
        .when(hours < 0, F.concat(F.lit("Etc/GMT+"), (-hours).cast("string")))
        .when(hours == 0, F.lit("Etc/GMT"))
    )


def built_in_places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, _LAYOUT)


def read_city_cache(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a coordinate cache; the file is a single JSON object."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(
        F.explode(F.from_json("value", "map<string, array<double>>")).alias(
            "city_name", "at"
        )
    )
    return entries.select(
        "city_name",
        F.try_element_at("at", F.lit(1)).alias("lat"),
        F.try_element_at("at", F.lit(2)).alias("lon"),
    )


def places(spark: SparkSession, cache_path: str | None = None) -> DataFrame:
    """The built-in list, with the coordinates of the cache taking precedence."""
    known = built_in_places(spark)
    if cache_path is None:
        return known
    cached = read_city_cache(spark, cache_path).select(
        "city_name", F.struct("lat", "lon").alias("at")
    )
    merged = known.join(cached, "city_name", "full")
    # A city listed as null in the cache is known to have no coordinates.
    lat = F.when(F.col("at").isNotNull(), F.col("at.lat")).otherwise(F.col("lat"))
    lon = F.when(F.col("at").isNotNull(), F.col("at.lon")).otherwise(F.col("lon"))
    zone = F.when(
        lat.isNotNull() & lon.isNotNull(),
        F.coalesce("timezone_iana", nautical_zone(lon)),
    )
    return merged.select(
        "city_name", lat.alias("lat"), lon.alias("lon"), zone.alias("timezone_iana")
    )
