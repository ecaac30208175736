"""Bindings of the library to the driver's test tables.

``inputs`` derives the domain inputs (search log, booking feed, warehouse
star schema, …) from the TPC-H-like tables with Spark; ``queries`` runs the
library on them, one callable per operator key; ``oracle`` holds the DuckDB SQL
that states the same result independently.
"""
