"""``DataFrame -> DataFrame`` operators. Lazy unless their docstring says otherwise."""
