"""arenaflow: a PySpark-native analytics engine for match-based field sports data."""
