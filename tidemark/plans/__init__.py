"""Extraction plans: filings and pages to rows. Regular text goes through column functions; markup that may be
malformed is parsed in Arrow batches, where a bad document gives no rows instead of failing the job."""
