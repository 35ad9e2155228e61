"""Operators for training-data pipelines: packing, classifiers, exact search,
tokenizers as Spark jobs, personal data, quality rules, near-duplicates and
web-archive revisits.  Nothing else in the library imports this subpackage.
"""
