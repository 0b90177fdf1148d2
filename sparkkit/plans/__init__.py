"""Domain questions composed from the operators."""
