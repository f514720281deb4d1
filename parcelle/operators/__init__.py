"""DataFrame -> DataFrame operators: filters, aggregations, conforming,
area filtering."""
