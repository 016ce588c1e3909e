"""Training-data operators: quality, PII, toxicity, search, dedup, packing, token files, decontamination, licences.

Nothing else in the library imports this package.
"""
