"""Plan building blocks that keep results exact when keys are skewed."""
