"""stintgraph: PySpark-native record linkage and analytics over employment tables."""
