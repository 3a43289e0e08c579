"""Compositions: the layered flows and the registered queries."""
