"""Where lines come from: text files, or the relational tables reshaped to lines."""
