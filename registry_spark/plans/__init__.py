"""Compositions of the operators: facilities, services, reports."""
