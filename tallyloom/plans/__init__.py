"""Named plans composed of operators."""
