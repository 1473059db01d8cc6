"""DataFrame to DataFrame; nothing here runs a job unless its docstring says so."""
