"""Data-quality, curve-mapping, curve-analytics and knowledge operators on Spark."""
