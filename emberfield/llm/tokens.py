"""Token ids of whole texts."""

from __future__ import annotations

import base64
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

# Outside these ranges the Unicode tables of the two libraries may classify a character differently.
_PLAIN = re.compile("[\u0000-ɏͰ-՗‐-⁞₠-₿]*")


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class ByteBpe:
    """Ids of a byte-level BPE as the tokenizers library gives them, as little-endian unsigned 32-bit bytes.

    The same vocabulary in tiktoken gives the same ids several times faster. A text with a
    special string, or with a character outside the plain ranges, goes through the tokenizers library itself.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        self.name = name
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._library: Tokenizer | None = None

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|endoftext|>" not in text and (_is_latin(text) or _PLAIN.fullmatch(text)):
            found = self._fast.encode_ordinary(text)
        else:
            if self._library is None:
                self._library = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))
            found = self._library.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()
