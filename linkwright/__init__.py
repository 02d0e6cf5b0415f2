"""linkwright: a PySpark-native entity-resolution and corpus-preparation engine."""
