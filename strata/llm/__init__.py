"""Training-data operators: one module per operator, one query per operator in ``registry``.

Nothing else in ``strata`` imports this subpackage.
"""
