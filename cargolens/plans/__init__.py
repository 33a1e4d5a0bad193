"""The warehouse layers and the analyses built on them."""
