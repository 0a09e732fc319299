"""Target tables and the jobs that fill them."""
