"""Jobs made of the operators, and the catalog of named queries."""
