"""strata: configuration-driven bronze / silver / gold pipelines as DataFrame plans."""
