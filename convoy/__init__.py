"""Fleet analytics as Spark jobs: raw events and files to warehouse, KPIs, live views, checks and a fuel model."""
