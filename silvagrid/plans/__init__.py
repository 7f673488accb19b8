"""Physical layout choices: staging, size-checked joins, blocks, composed plans."""
