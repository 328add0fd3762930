"""DataFrame -> DataFrame operators, one module per data product family."""
