"""Training-data operators: cleaning, deduplication, decontamination, tokenization and extraction.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
interface; :mod:`alignlake.llm.queries` applies the operators to the shared tables.
"""
