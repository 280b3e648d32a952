"""Models and jobs composed of the operators."""
