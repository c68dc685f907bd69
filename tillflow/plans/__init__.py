"""Named analytical queries.  Each takes DataFrames and plain arguments and
returns a lazy DataFrame; arguments are checked before anything is planned."""
