"""The models: staging, marts, trends, quality checks, reports and the pipeline."""
