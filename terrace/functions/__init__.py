"""Column expressions: status ladders, grids, geometry, statistics, strings."""
