
"""The warehouse object and the registered queries."""
