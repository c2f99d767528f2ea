"""Training-data operators (nothing else in the library imports this package).

One module per operator; ``queries`` registers one query per operator and the
pipeline, each over its whole table.
"""
