"""Where rows come from and go to: stored tables, message streams, feed payloads, test data."""
