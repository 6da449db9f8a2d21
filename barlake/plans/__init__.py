"""Jobs and registered queries put together from the operators."""
