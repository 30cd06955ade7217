"""Building analytics as Spark jobs: registers, geometry, tiles, features and reports."""

__version__ = "0.1.0"
