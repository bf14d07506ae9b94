"""The composed jobs: staging, dimensions, fact, reports, profiles, quality suite."""
