from strata.plans.oracle import ORACLE_SQL
from strata.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
