"""Operators for preparing training corpora, one module per operator.

Nothing outside this folder imports it; ``__spark_entry__`` registers its
queries when it is present.  Each module holds a general operator with its
real outputs; ``queries`` derives the registered result tables from them.
"""
