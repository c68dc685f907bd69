"""Column functions; every one is an expression Spark can compile."""
