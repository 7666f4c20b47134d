"""Business plans built from the operators: mart, checks, dashboards, studies."""
