"""Training-data operators.

Nothing outside this folder imports it; the repository works without it.
"""
