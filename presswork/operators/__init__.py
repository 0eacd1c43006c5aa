"""DataFrame -> DataFrame operators, without I/O."""
