"""Training-data operators: deduplication, decontamination, scoring, mixing, formatting, token output.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
