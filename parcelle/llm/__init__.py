"""Training-data operators: one module per operator, and the queries that
apply them to the whole driver tables (``parcelle.llm.queries``)."""
