"""Multi-band raster imagery as Spark tables."""
