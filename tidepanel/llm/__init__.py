"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage; `queries.py` lists the
registered queries. Conventions shared by all operators: inputs are plain
DataFrames with `doc_id`/`text` (or `page_id`/`url`/`html`) columns, further
columns are ignored whatever their names, a null text counts as empty, and
intermediate tables go to the folder named by `spark.checkpoint.dir`.
"""
