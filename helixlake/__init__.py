"""DataFrame operators for mapping protein structures to reference sequences, and for training-data pipelines."""
