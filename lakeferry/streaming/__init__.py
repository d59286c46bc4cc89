"""Forward-only reading of finite results."""
