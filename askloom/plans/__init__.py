"""The jobs users call, put together from the operators."""
