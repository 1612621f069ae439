"""Jobs: operators, tables and the run log put in order."""
