"""DataFrame -> DataFrame operators; every one is lazy unless its text says otherwise."""
