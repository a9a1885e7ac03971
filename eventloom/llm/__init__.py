"""Operators for preparing training text at scale.

Nothing outside this folder imports it.  ``queries`` holds what the driver
registers; the other modules each hold one operator.
"""
