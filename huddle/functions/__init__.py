"""Column expressions and the validation-check idiom (built-in functions only)."""
