"""Execution helpers shared by the operators (round materialisation, size
checks before broadcasting) and the catalogue of registered queries."""
