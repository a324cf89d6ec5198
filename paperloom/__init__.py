"""A PySpark-native engine for bibliographic records and citation graphs."""
