"""DataFrame -> DataFrame operators: roles, merges, periods, keys, audit."""
