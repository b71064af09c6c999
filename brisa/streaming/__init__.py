from .landing import land_available, read_new_csv

__all__ = ["land_available", "read_new_csv"]
