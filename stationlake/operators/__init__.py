"""DataFrame operators: cleaning framework, dimensions, facts, quality, features."""
