"""Operators for large text corpora (training-data preparation).

Nothing else in the library imports this subpackage; ``catalog.queries()``
holds one query per operator, and ``__spark_entry__`` adds them only when the
subpackage is present.
"""
