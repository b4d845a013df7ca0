"""The operators on the TPC-H-like tables, and the SQL that gives the same rows."""

from tsnorm.queries import files
from tsnorm.queries.oracles import ORACLES
from tsnorm.queries.tables import QUERIES

__all__ = ["ORACLES", "QUERIES", "files"]
