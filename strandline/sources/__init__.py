"""Sources: pixel tables, rasters by year, GeoJSON layers, and survey text files."""
