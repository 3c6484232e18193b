"""Retail order analytics as Spark jobs: medallion load, quality checks, reports, feeds and audits."""
