"""Composed jobs: the warehouse build and the registered queries."""
