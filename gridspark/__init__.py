"""gridspark: clean, typed tables from human-formatted report grids, planned by Spark."""
