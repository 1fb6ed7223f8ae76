"""The seven datasets, and the questions asked across them."""
