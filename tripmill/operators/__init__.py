"""DataFrame operators: batch unless a module says otherwise."""
