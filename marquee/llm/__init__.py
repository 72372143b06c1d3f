"""Training-data operators: ten dealt methods, each in a module of its own.

Nothing else in the library imports this subpackage; ``queries.py`` and
``oracle.py`` hold the registered queries and their SQL.
"""
