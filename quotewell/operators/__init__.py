
"""Views and queries of the warehouse."""
