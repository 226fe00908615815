from spanlake.sources.fixtures import load_table, derive  # noqa: F401
