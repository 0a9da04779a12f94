"""Trusted business metrics from raw tables, as Spark jobs.

    tables, failures = load_all(spark, "raw/")
    run_checks(tables, failures)
    star = write_star(spark, tables, "out/star")
    evaluate(star, ["revenue", "aov"], by=["dim_customer.state"])
"""
from .operators.checks import ChecksFailed, run_checks
from .operators.cleaning import clean, cleaning_log
from .plans.batch import open_star, run_batch, write_star
from .plans.catalogue import CATALOGUE
from .plans.integrity import IntegrityError, assert_star, check_star, data_dictionary, table_overview
from .plans.measures import MEASURES, evaluate
from .plans.star import Star, StoredStar, build_star
from .sources.csv_tables import load_all, load_table, read_star_csv, write_csv

__all__ = [
    "run_checks", "ChecksFailed", "clean", "cleaning_log", "open_star", "run_batch", "write_star", "CATALOGUE",
    "IntegrityError", "assert_star", "check_star", "data_dictionary", "table_overview", "MEASURES", "evaluate", "Star", "StoredStar",
    "build_star", "load_all", "load_table", "read_star_csv", "write_csv",
]
