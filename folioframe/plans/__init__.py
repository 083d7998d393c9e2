"""Pipelines composed from the operators, and the registered workload."""
