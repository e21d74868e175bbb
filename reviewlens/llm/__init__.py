"""Training-data operators: the ten numbered operators, their queries and the corpus pipeline's parts.

Nothing else in the library imports this subpackage.
"""
