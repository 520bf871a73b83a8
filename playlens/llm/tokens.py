"""Token ids of whole texts with a byte-level BPE given as a tokenizer file."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

EOS = 1

# Fixed value: the split that a byte-level pre-tokenizer of this kind applies to a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    """Path of the public vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Characters that stand for bytes in such files: printable ones for themselves,
    the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes texts as the file's tokenizer does without adding special tokens.

    A plain byte-level BPE whose merges are in the order of their ids gives the same
    ids by rank, which is five times as fast; any other file is left to its library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = file.read()
        spec = json.loads(content)
        ranks, special = self._ranks(spec)
        self.pieces: list[bytes] = []
        if ranks is None:
            library = Tokenizer.from_str(content)
            self.size = library.get_vocab_size()
            self.pieces = [library.decode([i], skip_special_tokens=False).encode() for i in range(self.size)]
            self.encode: Callable[[str], np.ndarray] = lambda text: np.array(
                library.encode(text, add_special_tokens=False).ids, "<u4"
            )
            return
        import tiktoken

        # The library's own registry lives as long as the worker, so each worker builds this once.
        known = tiktoken.registry.ENCODINGS
        if path not in known:
            known[path] = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        fast = known[path]
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.pieces = [b""] * self.size
        for piece, number in ranks.items():
            self.pieces[number] = piece

        def encode(text: str) -> np.ndarray:
            if any(name in text for name in special):
                return fast.encode_to_numpy(text, allowed_special="all")
            return fast.encode_to_numpy(text, disallowed_special=())

        self.encode = encode

    @staticmethod
    def _ranks(spec: dict) -> tuple[dict[bytes, int] | None, dict[str, int]]:
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        plain = (
            model["type"] == "BPE"
            and not spec.get("normalizer")
            and split == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec.get("added_tokens", []))
        )
        if not plain:
            return None, {}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        if [model["vocab"].get(m) for m in merges] != list(range(256, 256 + len(merges))):
            return None, {}
        byte = _byte_of_char()
        return {
            bytes(byte[c] for c in piece): n for piece, n in model["vocab"].items() if piece not in added
        }, added

    def document(self, text: str | None) -> np.ndarray:
        """Ids of a text followed by the end mark."""
        return np.append(self.encode(text).astype("<u4"), np.uint32(EOS)) if text else np.array([EOS], "<u4")
