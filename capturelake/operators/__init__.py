"""Part of capturelake; see README.md."""
