"""Encyclopedia HTML to markdown, tables and infoboxes: pure Python functions over a small document tree."""
