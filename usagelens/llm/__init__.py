"""Training-data operators: ten DataFrame operators and the queries that apply them."""
