"""Whole jobs, the fixture tables derived from the driver data, and the
query catalog wired into ``__spark_entry__``."""
