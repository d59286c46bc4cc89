"""Where tables come from: attached catalogs, the versioned store, live servers."""
