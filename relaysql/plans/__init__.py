"""Job plans: the batch runner and the catalogue of checked queries."""
