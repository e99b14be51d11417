"""Query plans composed from the operators: derivation layer, views, lookups, pipeline."""
