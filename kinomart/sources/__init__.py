"""Where the fifteen base tables come from and where results go."""
