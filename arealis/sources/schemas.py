"""Explicit schemas: no source is inferred from its content."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _REAL = T.StringType(), T.DoubleType()


def text_fields(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TEXT) for n in names])


# Monthly street-crime extracts, columns in file order.
EVENTS = T.StructType([
    T.StructField("Crime ID", _TEXT), T.StructField("Month", _TEXT),
    T.StructField("Reported by", _TEXT), T.StructField("Falls within", _TEXT),
    T.StructField("Longitude", _REAL), T.StructField("Latitude", _REAL),
    T.StructField("Location", _TEXT), T.StructField("LSOA code", _TEXT),
    T.StructField("LSOA name", _TEXT), T.StructField("Crime type", _TEXT),
    T.StructField("Last outcome category", _TEXT), T.StructField("Context", _TEXT)])

# Area lookup, columns in output order.
AREA_LOOKUP = text_fields("OA21CD", "LSOA21CD", "LSOA21NM", "LSOA11CD", "CHGIND", "MSOA21CD",
                          "MSOA21NM", "WD24CD", "WD24NM", "LAD22CD", "LAD22NM")

# Columns taken from the three lookup files, in join order.
LOOKUP_FILES = (
    ("OA21CD", "LSOA21CD", "LSOA21NM", "MSOA21CD", "MSOA21NM"),
    ("LSOA21CD", "LSOA11CD", "CHGIND", "LAD22CD", "LAD22NM"),
    ("LSOA21CD", "WD24CD", "WD24NM"),
)

# Column positions of the deprivation tables, their headers in the middle version,
# and the headers of the others that differ from it.
IMD_POSITIONS = {2010: (0, 7, 9, 11, 13, 15, 17, 19, 21), 2015: (0, 4, 7, 10, 13, 16, 19, 22, 25),
                 2019: (0, 4, 7, 10, 13, 16, 19, 22, 25)}
IMD_COLUMNS = ("LSOA code (2011)", "IMD Score", "Income Score (rate)", "Employment Score (rate)",
               "Education, Skills and Training Score", "Health Deprivation and Disability Score",
               "Crime Score", "Barriers to Housing and Services Score", "Living Environment Score")
IMD_2010_HEADERS = {
    "LSOA": "LSOA code (2011)",
    "IMD SCORE": "IMD Score",
    "INCOME SCORE": "Income Score (rate)",
    "EMPLOYMENT SCORE": "Employment Score (rate)",
    "EDUCATION SKILLS AND TRAINING SCORE": "Education, Skills and Training Score",
    "HEALTH DEPRIVATION AND DISABILITY SCORE": "Health Deprivation and Disability Score",
    "CRIME AND DISORDER SCORE": "Crime Score",
    "BARRIERS TO HOUSING AND SERVICES SCORE": "Barriers to Housing and Services Score",
    "LIVING ENVIRONMENT SCORE": "Living Environment Score",
}
IMD_2019_HEADERS = {"Index of Multiple Deprivation (IMD) Score": "IMD Score"}

# Validity of the deprivation versions: first and last panel year.
IMD_YEARS = {2010: (2010, 2014), 2015: (2015, 2018), 2019: (2019, None)}

# Names under which the location key appears.
LOCATION_NAMES = ("LSOA_code", "LSOA code", "lsoa_code", "LSOA21CD", "LSOA 2021 Code")

# Land-cover columns that count as residential, text columns of the dwelling stock.
RESIDENTIAL_COLUMNS = ("Continuous urban fabric [111] (2018)", "Discontinuous urban fabric [112] (2018)")
HOUSING_TEXT = ("GEOGRAPHY", "ECODE", "AREA_NAME", "BAND")
