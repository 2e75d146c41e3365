"""Operators for preparing training data: one module per operator, each usable alone on any table.

``queries`` registers one query per operator; nothing else in the library imports this subpackage.
"""
