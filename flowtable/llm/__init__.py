"""Training-data pipeline operators. Nothing else in the library imports this
subpackage; ``queries`` holds the registered queries and their oracles."""
