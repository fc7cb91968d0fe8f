"""Column functions: tags, strings, paths, media decisions, prompts and result parsing."""
