"""PySpark-native event-fusion analytics: DataFrame in, DataFrame out."""
