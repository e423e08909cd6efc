"""DataFrame operators of the pipeline (ETL, training reads, CCO,
popularity, similarity, payloads, serving)."""
