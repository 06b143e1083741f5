"""Where rows come from and go to: delimited text, Parquet, catalog tables, the star."""
