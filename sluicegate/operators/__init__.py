"""Filter, batching, ledger and reporting operators over event tables."""
