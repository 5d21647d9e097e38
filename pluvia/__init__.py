"""Spark-native analytics for rainy-season timing: detection, climatology, blending and scoring."""
