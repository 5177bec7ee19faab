"""Named jobs, composed of the operators."""
