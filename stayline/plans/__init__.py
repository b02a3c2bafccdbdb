"""End-to-end jobs composed of operators; any scheduler can call them."""
