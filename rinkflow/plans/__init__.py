"""Adapter views and the query plans over them."""
