"""End-to-end plans built from the operators: cleaning, serving, landing,
area records and the job runner."""
