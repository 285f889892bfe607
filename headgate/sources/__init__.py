"""Where rows come from: tables, relational databases, manifests, file listings, user code."""
