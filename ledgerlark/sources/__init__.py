"""Landing readers, table writers and the star-schema input view."""
