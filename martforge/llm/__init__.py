"""Training-data operators: thirteen corpus operators and their registered queries."""
