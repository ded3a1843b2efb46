"""graphloom: table-to-graph jobs on Spark (see README.md)."""

__version__ = "0.1.0"
