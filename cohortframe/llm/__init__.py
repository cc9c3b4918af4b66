"""Operators of a training-data pipeline: near duplicates, search, line and benchmark
decontamination, archives, tokenizing, extraction, language and URL classifiers, chat records.

Nothing else in the library imports this subpackage.
"""
