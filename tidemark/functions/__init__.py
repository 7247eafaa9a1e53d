"""Column-level building blocks: fixed values, time, polygons and cells."""
