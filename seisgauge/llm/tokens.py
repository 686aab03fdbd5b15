"""Token ids of texts by a tokenizer of the ``tokenizers`` library, inside tasks.

A tokenizer that drops white space and treats words alone gives a text the ids of its words, one
after the other. Such a tokenizer is recognised by its settings; its words are then encoded once
and remembered, up to a bound and to the end of the task. Words of plain letters, with or without
marks behind them, skip the normalizing steps, which do nothing to them but lower their case. Any
other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import re

import numpy as np
from tokenizers import Tokenizer

from .memory import until_the_task_ends

#: Words remembered by a task, and the longest of them: some 100 MB, with their letters alone.
REMEMBERED, LONGEST = 300_000, 40

#: Letters, then marks that are one piece: all of ASCII but ``'`` and ``<``, which may begin others.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
IDS = np.dtype("<u4")


def _byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for
    themselves, the others by characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _by_words(settings: dict) -> bool:
    """Whether the settings are those described above."""
    normal, pre = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    normal_steps = [step["type"] for step in normal.get("normalizers", ())]
    pre_steps = pre.get("pretokenizers", ())
    return (
        normal_steps == ["NFC", "Replace", "Lowercase"]
        and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and [step["type"] for step in pre_steps] == ["Split", "ByteLevel"]
        and pre_steps[0]["behavior"] == "Removed"
        and pre_steps[0]["invert"]
        and r"[^\s\p{L}\p{N}]+" in pre_steps[0]["pattern"].get("Regex", "")
        and not pre_steps[1]["add_prefix_space"]
        and settings["model"]["type"] == "BPE"
        and settings.get("post_processor") is None
    )


class _Words(dict):
    """Ids of words, as bytes."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.symbols = _byte_symbols()
        self.cores: dict[str, bytes] = until_the_task_ends({})
        until_the_task_ends(self)

    def core(self, letters: str) -> bytes:
        found = self.cores.get(letters)
        if found is None:
            spelled = letters
            if not letters.isascii():
                spelled = letters.encode().decode("latin-1").translate(self.symbols)
            found = np.array([t.id for t in self.model.tokenize(spelled)], IDS).tobytes()
            if len(self.cores) < REMEMBERED and len(letters) <= LONGEST:
                self.cores[letters] = found
        return found

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain:
            ids = self.core(plain[1].lower())
            if plain[2]:
                ids += self.core(plain[2])
        else:
            encoded = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = np.array(encoded, IDS).tobytes()
        if len(self) < REMEMBERED and len(word) <= LONGEST:
            self[word] = ids
        return ids


class Encoder:
    """``encoder(text)``: the ids as bytes, little-endian unsigned 32-bit."""

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.words = _Words(self.tokenizer) if _by_words(json.load(file)) else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder of this file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __call__(self, text: str) -> bytes:
        if self.words is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, IDS).tobytes()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
