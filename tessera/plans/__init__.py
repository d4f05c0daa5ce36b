"""Configurations of the operators.

missions    the mission ETL: raw CSV -> cleaned -> star schema -> checks -> refresh; views, wide loaders
eda         the two notebooks' analyses as named DataFrames over the mission warehouse
driver      the same operators bound to the driver's TPC-H-like tables (queries())
driver_sql  the DuckDB SQL oracle for each of those queries
"""
