"""Multi-step plans: the named query catalog (with SQL oracles), training /
tuning / selection, and the model registry."""
