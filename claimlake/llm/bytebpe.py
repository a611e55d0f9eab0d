"""Token ids of whole texts by the public byte-level BPE vocabulary.

Paths of the vocabulary files are parameters; they are read inside the tasks,
once per Python worker. Texts of ASCII and Latin-1 characters are cut by the
vocabulary's own rule for pre-tokens; every distinct pre-token is encoded once,
from the file of the same vocabulary as ranks, and remembered. All other texts,
and those that hold a special token, go to the tokenizer whole. Both ways give
the ids that the tokenizer gives for the whole text.
"""

from __future__ import annotations

import base64
import os
import re
from array import array

import numpy as np

# The pre-token rule of the published vocabulary, for characters below U+0100.
_LETTER, _DIGIT, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t\n\r\x0b\x0c"
PRETOKENS = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Characters for which the rule above is the tokenizer's rule beyond doubt.
SIMPLE = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa1-\xac\xae-\xff]*")
#: The memory of one worker is emptied at this number of pre-tokens; it is only a memory.
MEMORY = 300_000

_loaded: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str, ranks_path: str):
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        # pre-tokens come one by one, so the pattern need not cut
        self.ranks = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not SIMPLE.fullmatch(text) or any(s in text for s in self.special):
            return self._whole(text)
        known, parts = self.known, PRETOKENS.findall(text)
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            return b"".join([known.get(p) or self._learn(p) for p in parts])

    def forget(self) -> None:
        """Gives back the memory of pre-tokens."""
        self.known = {}

    def _learn(self, part: str) -> bytes:
        ids = array("I", self.ranks.encode_ordinary(part)).tobytes()
        if len(part) <= 100:
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[part] = ids
        return ids


def encoder(path: str, ranks_path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path, ranks_path)
    return _loaded[path]
