"""Jobs: staging reports, core load, views, analysis, quality checks, refresh."""
