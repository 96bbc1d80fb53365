"""Training-data operators: dedup, toxicity, PII, tokenising, quality rules, packing.

Nothing else in the library imports this package; the registered queries and
their SQL are in ``starmart.llm.queries``.
"""
