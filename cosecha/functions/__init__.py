"""Column functions: text, dates, arithmetic, classes.  All stay inside code generation; none is a UDF."""
