"""Reading, input layers, and the artifact protocol of runs."""
