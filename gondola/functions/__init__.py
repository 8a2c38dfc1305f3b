"""Column expressions: text, price and URL rules, and helpers over them."""
