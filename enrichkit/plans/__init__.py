"""Derived test inputs and the catalogue of registered queries."""
