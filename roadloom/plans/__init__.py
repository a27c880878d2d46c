"""User-facing jobs: graph builds, routes and service areas."""
