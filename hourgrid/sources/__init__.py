"""Where rows come from: monthly trip files, stored tables, generated hours."""
