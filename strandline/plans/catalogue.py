"""All queries by name, and the equivalent SQL of those that SQL can express."""

from strandline.plans import adapters, layers, pixels, rasters, rates, spatial, surveys

PARTS = (pixels, rates, spatial, layers, surveys, rasters, adapters)
QUERIES = {name: f for part in PARTS for name, f in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in PARTS for name, sql in part.ORACLE_SQL.items()}
