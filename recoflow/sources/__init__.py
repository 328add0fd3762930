"""Reading and writing: tables, keyed stores, streams, test-data adapters."""
