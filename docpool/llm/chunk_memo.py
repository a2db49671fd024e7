"""Encoding texts chunk by chunk, each distinct chunk once.

A word that follows one space is tokenized alike wherever it stands, for tokenizers that never merge
across the place before a space. Texts are cut there; chunks seen before come from a table, new ones
go to the library in one call for a whole batch. The table is cut back when it holds MOST entries, so
its memory is bounded.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import islice
from typing import TypeVar

os.environ["TOKENIZERS_PARALLELISM"] = "false"

T = TypeVar("T")
MOST = 400_000
#: Longer chunks are encoded each time.
LONGEST = 48


class Memo:
    """What `encode` gives for each chunk; it takes many chunks and must treat each by itself."""

    def __init__(self, encode: Callable[[list[str]], list[T]]):
        self.encode, self.known = encode, {}

    def values(self, chunks: list[str]) -> list[T]:
        """The value of each chunk, in order."""
        known = self.known
        out = list(map(known.get, chunks))
        missing = [i for i, v in enumerate(out) if v is None]
        if missing:
            new = list({chunks[i] for i in missing})
            if len(known) + len(new) > MOST:
                # what this call needs of the old entries stays
                known = self.known = {w: v for w, v in zip(chunks, out) if v is not None}
            fresh = dict(zip(new, self.encode(new)))
            known.update((w, v) for w, v in fresh.items() if len(w) <= LONGEST)
            for i in missing:
                out[i] = fresh[chunks[i]]
        return out

    def rows(self, cut: list[list[str]]) -> list[list[T]]:
        """For each text, given as its chunks, the values of its chunks."""
        flat = iter(self.values([w for x in cut for w in x]))
        return [list(islice(flat, len(x))) for x in cut]
