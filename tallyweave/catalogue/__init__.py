from tallyweave.catalogue import checks, classes, counts, fields, jobs, reshape, stores, tables, weighting
from tallyweave.catalogue.registry import QUERIES, Query

__all__ = ["QUERIES", "Query", "checks", "classes", "counts", "fields", "jobs", "reshape", "stores", "tables", "weighting"]
