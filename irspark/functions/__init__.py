"""Column builders."""
