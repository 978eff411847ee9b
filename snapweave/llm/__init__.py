"""Training-data operators: filters, deduplication, decontamination, mixing and archives.

Nothing outside this subpackage imports it.  ``queries.py`` registers one query
per operator; ``__spark_entry__`` adds them when the subpackage is present.
"""
