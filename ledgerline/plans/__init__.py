"""The reference's pipelines and queries, composed from operators."""
