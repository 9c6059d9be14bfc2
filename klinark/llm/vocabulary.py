"""Where the public vocabulary lies, and the pattern that goes with it."""

from __future__ import annotations

import os

import public_tokenizers

PATTERN = public_tokenizers.PATTERN  # splits text before the merges of the rank file
EOD = 50256  # free id that closes a document


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Path of a vocabulary file; it is read on the driver only."""
    folder = folder or os.environ.get("TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)
