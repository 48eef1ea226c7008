"""Spark-native aid-statistics engine: typed sources, dimension filters, code translation, totals and sinks."""
