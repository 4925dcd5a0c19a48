"""PySpark-native toolkit for tabular risk scoring on time-stamped records."""
