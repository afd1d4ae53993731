"""Byte-pair token ids of whole texts through a rank file, with a bounded memory of the pieces seen."""

from __future__ import annotations

import base64
import re

import numpy as np

from .common import ship

#: pieces remembered per task; the memory is emptied when it is full, so its size does not grow with the input
MEMORY = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: white space besides blank and line feed, which texts rarely hold
ASCII_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
OTHER_SPACES = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
CUT = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str) -> list[str]:
    """``text`` cut at each blank between characters that are not white space; the blanks are left out.

    There every match of the pre-tokenising pattern starts anew, as a blank only joins what follows it, so segments can be
    encoded on their own: the first as it is, the others with a blank in front.
    """
    odd = (text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or any(c in text for c in ASCII_SPACES)
           or not text.isascii() and any(c in text for c in OTHER_SPACES))
    return CUT.split(text) if odd else text.split(" ")


class Encoder:
    """``encode(text)`` gives the ids as little-endian uint16, or uint32 if the vocabulary needs it.

    The segments of a text are encoded on their own and remembered.
    """

    def __init__(self, path: str, pattern: str, special: dict[str, int] | None = None, memory: int = MEMORY):
        import tiktoken

        ranks = read_ranks(path)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special or {})
        self.allowed = set(special or {})
        self.size = max([*ranks.values(), *(special or {}).values()]) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.memory: dict[str, bytes] = {}
        self.limit = memory

    def piece(self, text: str) -> bytes:
        return np.array(self.library.encode(text, allowed_special=self.allowed, disallowed_special=()), self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        parts = segments(text)
        known = self.memory
        if len(known) > self.limit:
            known.clear()
        found = [known.get(p) for p in parts[1:]]
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i + 1]
                    found[i] = known[part] = self.piece(" " + part)
        return self.piece(parts[0]) + b"".join(found)


ship(__name__)
