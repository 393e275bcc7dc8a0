"""Readers and writers: catalogues, rasters, annotations, products, polygons, orbits, files."""
