"""Tables of fixed values, layers, bindings and the query registry."""
