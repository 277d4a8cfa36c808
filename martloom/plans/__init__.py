"""The layers of the star schema, built from the operators."""
