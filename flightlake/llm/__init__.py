"""Training-data operators: decontamination, sharding, toxicity, mixing, URL
filters, quality, near-dedup, WARC derivatives, chat formatting, exact search.

Nothing outside this package imports it; ``queries`` registers its queries.
"""
