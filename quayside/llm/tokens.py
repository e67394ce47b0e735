"""Byte-level BPE ids, the same as the tokenizers library gives for the vocabulary file."""

from __future__ import annotations

import numpy as np

END_OF_TEXT = "<|endoftext|>"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts; one per task, made from a vocabulary file of the tokenizers library.

    A token's rank in such a file is its id, so a rank encoder gives the same ids several times
    faster. The end-of-text string is its special token. Texts that the rank encoder refuses go to
    the tokenizers library.
    """

    def __init__(self, path: str):
        import json

        import public_tokenizers
        import tiktoken

        self._path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in spec["model"]["vocab"].items() if token not in special
        }
        self._encoding = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, number in ranks.items():
            self.bytes[number] = token
        for token, number in special.items():
            self.bytes[number] = token.encode()
        self._slow = None

    def encode(self, text: str) -> np.ndarray:
        """The ids, as unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, np.uint32)
        try:
            return self._encoding.encode_to_numpy(text, allowed_special="all")
        except (ValueError, RuntimeError, BaseException) as e:
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(self._library().encode(text, add_special_tokens=False).ids, np.uint32)

    def _library(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
            self._slow.no_truncation()
            self._slow.no_padding()
        return self._slow

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes; special tokens are kept."""
        table = self.bytes
        return b"".join([table[i] for i in ids.tolist()])


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 characters
    stand for themselves, the others for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}
