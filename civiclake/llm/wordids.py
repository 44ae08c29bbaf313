"""Whole texts to ids of a ``tokenizers`` word vocabulary (lower case, white space dropped, word-end symbols)."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

import numpy as np

_ENCODERS: dict[str, "WordEncoder"] = {}
#: Letters for which lower case, composition and the letter class are the same everywhere.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[{_LETTERS}\n .,]*")
_LATIN = re.compile(rf"[{_LETTERS}\t-\r -~]*")
#: The vocabulary's own pre-token pattern, for texts of those letters and ASCII.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-zß-öø-ÿ0-9]+")


class WordEncoder:
    """Ids of whole texts, as ``tokenizers`` gives them with add_special_tokens=False; an added token's string in a text gives its id.

    Three ways by the characters of a text, all with the same ids: words, full stops and commas only (marked with
    plain string replacement); other ASCII (cut by the pre-token pattern); anything else (the library itself). The
    first two hand the pre-tokens to the merge engine below, with a zero byte after each. ``tokenizers`` itself
    makes 1 MB/s on such words, the engine 5 MB/s and more.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.lib.get_added_tokens_decoder().values()]
        self.fast, self.ids = _merge_engine(path)

    def text(self, text: str | None) -> np.ndarray:
        """Ids of one text; a null text has none."""
        if not text:
            return np.empty(0, "<u4")
        if _PLAIN.fullmatch(text) and not any(x in text for x in ("..", ",,", ".,", ",.")):
            t = text.lower().replace("\n", " ").replace(".", " . ").replace(",", " , ")
            t = " ".join(t.split()).replace(" ", "\0")
        elif _LATIN.fullmatch(text) and not any(x in text.lower() for x in self.added):
            t = "\0".join(_PIECE.findall(text.lower()))
        else:
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4")
        return self.ids[self.fast.encode_to_numpy(t + "\0")] if t else np.empty(0, "<u4")


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _merge_engine(path: str):
    """The vocabulary's merge list as tiktoken ranks.

    A word end is a zero byte after the last letter; joining it to that letter comes before all merges, as the
    vocabulary's word-end symbols ask. Gives the engine and the vocabulary's id of each rank.
    Tests hold the ids against the library's own.
    """
    import tiktoken

    model = json.loads(Path(path).read_text())["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    raw = lambda t: bytes(byte[c] for c in t.removesuffix("</w>")) + b"\0" * t.endswith("</w>")
    ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 255 + b for b in range(1, 256)}
    for pair in model["merges"]:
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        ranks.setdefault(raw(a) + raw(b), len(ranks))
    ids = np.zeros(len(ranks), "<u4")
    for token, i in model["vocab"].items():
        if (r := ranks.get(raw(token) if all(c in byte for c in token.removesuffix("</w>")) else b"")) is not None:
            ids[r] = i
    return tiktoken.Encoding("letters", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), ids
