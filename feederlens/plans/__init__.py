"""The layered tables, composed from the operators."""
