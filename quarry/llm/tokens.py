"""Token ids of whole texts by a tokenizer file of the tokenizers library."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

from tokenizers import Tokenizer

#: str.split() parts words at these, the tokenizer's \s does not; texts with one are encoded in one piece.
_ODD = re.compile("[\x1c-\x1f]")


#: A byte-level vocabulary writes printable bytes as they are and the others, in order, as characters from 256.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


#: What a tokenizers file says of a tokenizer that encodes runs of letters, single digits and runs of signs on their own.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def parts_words(tokenizer: Tokenizer) -> bool:
    """Whether texts may be encoded by their pieces: the tokenizer has the shape above, a byte-level model, and no special token that takes in white space."""
    made = json.loads(tokenizer.to_str())
    model = made["model"]
    plain = model.get("type") == "BPE" and not model.get("dropout") and not model.get("byte_fallback") and not model.get("ignore_merges")
    special = any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in made["added_tokens"])
    return (made["normalizer"], made["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER) and plain and not special


class Encoder(dict):
    """Ids as little-endian unsigned 32-bit bytes.

    Where the tokenizer never joins text over white space (see parts_words()), each white-space-parted
    piece of a text is encoded once and kept, while there are fewer than `limit`; a piece of letters
    with signs after them is put together from the two. The result equals that of encoding the text.
    By any other tokenizer whole texts are encoded.
    """

    def __init__(self, path: str, limit: int = 500_000):
        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.parted = parts_words(self.tokenizer)
        self.bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self.bytes[i] for i in ids])

    def _kept(self, piece: str, ids: bytes) -> bytes:
        if len(self) < self.limit and len(piece) <= 64:
            self[piece] = ids
        return ids

    def _letters(self, letters: str) -> bytes:
        """Folded letters, which the library's model takes as they are, byte for character."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTES)
        return b"".join([self.bytes[t.id] for t in self.tokenizer.model.tokenize(letters)])

    def __missing__(self, piece: str) -> bytes:
        low = piece.lower()
        letters = low.rstrip(",.;:!?")
        # the library folds each character by itself, str.lower() looks around a capital sigma
        if not (letters.isalpha() and (piece.isascii() or "\u03a3" not in piece and unicodedata.is_normalized("NFC", low))):
            return self._kept(piece, self._encode(piece))
        ids = self.get(letters)
        if ids is None:
            ids = self._kept(letters, self._letters(letters))
        if piece == letters:
            return ids
        if len(letters) < len(low):
            signs = low[len(letters) :]
            ids += self.get(signs) or self._kept(signs, self._encode(signs))
        return self._kept(piece, ids)

    def ids(self, text: str | None, end: int | None = None) -> bytes:
        """Of null as of the empty text; end: the id to append."""
        last = b"" if end is None else end.to_bytes(4, "little")
        if not text:
            return last
        if not self.parted or _ODD.search(text):
            return self._encode(text) + last
        return b"".join(map(self.__getitem__, text.split())) + last


@cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)
