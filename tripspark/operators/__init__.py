"""DataFrame operators: ingest, cleaning, features, batching, versions, training, scoring."""
