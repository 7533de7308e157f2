"""Public tokenizer files inside Python workers: loaded once a worker, with a bounded memory of words."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

from . import common

#: Before white space that follows something else.
SPACE = re.compile(r"(?<=\S)(?=[ \t\n\r])")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizers library's tokenizer of a .json file, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Memory:
    """What a tokenizer gives for each distinct piece of text, kept for at most ``most`` pieces of up to ``longest`` characters.

    Pieces that do not fit are encoded anew in every batch; results never depend on what is kept.
    """

    def __init__(self, path: str, value: Callable, most: int = 600_000, longest: int = 48):
        self.path, self.value, self.most, self.longest, self.kept = path, value, most, longest, {}

    def each(self, texts: list[list[str]]) -> Iterator[Iterator]:
        """For each list of pieces, the values of its pieces."""
        kept = self.kept
        new = list(set(chain.from_iterable(texts)).difference(kept))
        t = tokenizer(self.path)
        for a in range(0, len(new), 4096):
            part = new[a : a + 4096]
            kept.update(zip(part, (self.value(e.ids) for e in t.encode_batch_fast(part, add_special_tokens=False)), strict=True))
        for pieces in texts:
            yield map(kept.__getitem__, pieces)
        full = len(kept) > self.most  # the frequent ones came first
        for w in new:
            if full or len(w) > self.longest:
                del kept[w]


def memory(path: str, kind: str) -> Memory:
    """The worker's one for a file and kind of value (counts, or ids as little-endian 32-bit bytes), until it turns to other work."""
    import numpy as np

    held = common.kept(f"{kind} of {path}")
    if "memory" not in held:
        held["memory"] = Memory(path, len if kind == "count" else lambda ids: np.array(ids, "<u4").tobytes())
    return held["memory"]
