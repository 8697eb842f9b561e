"""Tables of the layered model and the analysts' queries over them."""
