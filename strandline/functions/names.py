"""Names and codes: recoding tables, and text taken apart."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of survey methods; None means that the method is not known.
SURVEY_METHODS = {
    "emery": "emery/levelling",
    "levelling": "emery/levelling",
    "dunefill": None,
    "rtk gps": "gps",
    "photogrammetry": "aerial photogrammetry",
    "stereo photogrammtery": "aerial photogrammetry",
    "ads80": "aerial photogrammetry",
    "photos": "aerial photogrammetry",
    "total station": "total station",
    "total station\t": "total station",
    "laser scanning": "terrestrial laser scanning",
    "satellite": "satellite",
    "gps rtk gps": "gps",
}


def recode(value: Column, table: Mapping[str, str | None]) -> Column:
    """The table's entry, or the value itself where it has none; one constant lookup."""
    known = {k: v for k, v in table.items() if v is not None}
    lost = [k for k, v in table.items() if v is None]
    found = F.coalesce(F.create_map(*(F.lit(x) for kv in known.items() for x in kv))[value], value) if known else value
    return F.when(~value.isin(*lost), found) if lost else found


def standard_method(value: Column) -> Column:
    return recode(F.lower(value), SURVEY_METHODS)
