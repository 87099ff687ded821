"""Training-data operators: quality, language, duplicates, toxicity, mixing,
PII, tokenisation and archives, each as a Spark job over whole tables.

Nothing outside this subpackage imports it; ``llm.catalog`` holds the
registered queries.
"""
