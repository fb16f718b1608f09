"""DataFrame operators: routes, matching, analytics, sampling, synthesis, model."""
