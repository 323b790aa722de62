"""Operators for preparing language-model training text, one module per method.

Each operator takes DataFrames with any id and text column and returns DataFrames or columns;
``contract.py`` holds the registered queries, ``corpus_pipeline.py`` at the repository top
chains the operators.  Nothing else in the library imports this package.
"""
