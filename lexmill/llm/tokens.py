"""Token ids of whole texts with the ``tokenizers`` library, many times faster on repeated pieces."""

from __future__ import annotations

import json
import re
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

from lexmill.llm.bpe import byte_symbols
from lexmill.llm.common import worker_memory

# Fixed value: the split that byte-level BPE of this family makes before it merges is
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# Scripts in which all Unicode versions agree on letters, digits and white space, and Python's own classes with them:
# without the numbers that are no decimal digits, and the separators that Python takes for white space.
_OTHER = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u1e00-\u1eff\u2010-\u203a\u20ac]")
# The split in Python's classes, for texts of those scripts.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
REMEMBERED = 500_000  # pieces; about 100 MB in a worker


class _Pieces(dict):
    """piece -> packed ids, remembered within bounds; a new piece goes to the library's merges alone."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.merge, self.symbols = tokenizer.model.tokenize, dict(enumerate(byte_symbols()))

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            # The pieces seen first are the frequent ones.
            first = list(islice(self.items(), REMEMBERED // 2))
            self.clear()
            self.update(first)
        found = self.merge(piece.encode("utf-8").decode("latin-1").translate(self.symbols))
        ids = self[piece] = np.array([t.id for t in found], dtype="<u4").tobytes()
        return ids


class Encoder:
    """Texts to packed ids, little-endian unsigned 32-bit.

    With a byte-level tokenizer the ids of a text are those of its pieces one after
    the other, so each piece is merged by the library once and then remembered
    (within bounds). Other tokenizers and scripts go to the library as whole texts.
    Special strings inside a text are ordinary text. A null text is an empty one.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        plan = json.loads(tokenizer_json)
        pre = plan.get("pre_tokenizer") or {}
        self.by_piece = (plan.get("normalizer") is None and plan["model"].get("type") == "BPE"
                         and not plan["model"].get("dropout")
                         and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                         and not pre.get("add_prefix_space"))
        self.known = _Pieces(self.tokenizer)

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text."""
        out, whole, ids_of = [b""] * len(texts), [], self.known.__getitem__
        for k, text in enumerate(texts):
            if text and self.by_piece and not _OTHER.search(text):
                out[k] = b"".join(map(ids_of, _PLAIN.findall(text)))
            elif text:
                whole.append(k)
        if whole:
            found = self.tokenizer.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False)
            for k, e in zip(whole, found):
                out[k] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.frombuffer(ids, dtype="<u4") for ids in self.packed(texts)]


_ENCODERS: dict[int, Encoder] = worker_memory({})


def encoder(tokenizer_json: str) -> Encoder:
    """One encoder for each tokenizer in a worker, until it turns to another module's tasks."""
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json)
    return _ENCODERS[key]


def read_tokenizer(path: str) -> str:
    """The tokenizer file's content: the driver reads it, so executors need no file."""
    with open(path, encoding="utf-8") as f:
        return f.read()
