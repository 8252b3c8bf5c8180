"""Column expressions: numbers, statistics, geometry, geodesy and names. No UDFs."""
