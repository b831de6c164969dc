"""Whole runs built from the operators, and the inputs and SQL of the registered queries."""
