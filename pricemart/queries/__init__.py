"""Driver queries: the library's operators run over the provided test tables.

``inputs`` renders stand-in inputs (rows in the schema each job expects) from the
TPC-H-like tables; ``catalog`` holds one Spark callable per operator key and
``oracle`` the equivalent DuckDB SQL.
"""
