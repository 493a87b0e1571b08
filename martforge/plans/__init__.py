"""Domain pipelines (D1-D11) built from the operators."""
