"""Token ids of whole texts from a public byte-level BPE file.

The tokenizer's JSON file is the only input.  Where its merges are in the order
of their ids, the same vocabulary is loaded as ranks, which code a text several
times faster with the same ids; otherwise, and for texts the fast coder cannot
take, the tokenizer itself is used.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

#: Fixed value: the pattern that byte-level BPE files with ``use_regex`` split by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 100_000


def _ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes to id, if the file's merges rank as its ids do."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if model.get("type") != "BPE" or not plain or spec.get("normalizer"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab[a + b] for a, b in pairs]
    if order != sorted(order):
        return None
    return {bytes(byte_of[c] for c in word): i for word, i in vocab.items() if word not in special}


class Coder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a text cannot forge control ids
        ranks, self.fast = _ranks(path), None
        if ranks is not None:
            import tiktoken
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text, unsigned 32-bit; null has none."""
        if not text:
            return np.zeros(0, dtype="<u4")
        if self.fast is not None and len(text) < LONG:
            return self.fast.encode_to_numpy(text).astype("<u4", copy=False)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder per worker process and file."""
    return Coder(path)


def default_path() -> str:
    """The public byte-level vocabulary installed beside the tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
