"""The jobs: what is read, which operators run, and the rows that are reported."""
