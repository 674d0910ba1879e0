"""DataFrame operators: one function per operator, ``fn(df, ...) -> DataFrame``."""
