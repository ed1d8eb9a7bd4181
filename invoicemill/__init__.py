"""Invoice analytics as Spark jobs: ingest, extract, validate, land, model, report."""
