"""Where the public vocabularies are on this installation. The operators take such places as parameters."""

from __future__ import annotations

from keyflow.llm.packing import added_tokens


def tokenizer() -> tuple[str, str]:
    """The place of the byte-level vocabulary of 50,257 ids, and its pattern of word pieces."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def added() -> dict[str, int]:
    """The tokens that the tokenizers file of the same vocabulary adds to it, with their ids."""
    import public_tokenizers

    return added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def pieces() -> str:
    """The place of the vocabulary of word pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
