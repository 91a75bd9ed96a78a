"""Operators that prepare training data for language models.

Nothing else in the library imports this subpackage.  Each module holds one operator with a
general interface; ``varspark.llm.queries`` derives the registered result tables from them.
"""
