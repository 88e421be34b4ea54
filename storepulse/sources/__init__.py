"""Where rows come from: topics, change feeds, tables, and test-data bindings."""
