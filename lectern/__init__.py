"""Lectern: Spark-native preparation and auditing of paired text/audio corpora."""
