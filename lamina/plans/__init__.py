"""The trip pipeline: configuration of the operators, layer jobs and quality gates."""
