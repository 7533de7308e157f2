"""Token counts, with overlap resynchronisation for huge documents.

A huge text is encoded in chunks that overlap, with the offsets of their tokens. Two neighbouring encodings are
spliced where both start a token, away from the cut ends of either, and agree on that token. Such a boundary is
proven stable: byte-pair merges of a text are the one sequence of tokens in which any two neighbours within a
pre-token, encoded by themselves, stay as they are. The token before the splice and the one after it are
neighbours in the first encoding, and all other neighbours are so in the first or in the second, so the spliced
sequence is that of the whole text. Cut ends spoil only what lies within ``MARGIN`` characters of them: a
contraction, a special string, or white space that looks ahead. A chunk starts where the last one starts a token,
so the two mostly agree at once, in any script and without white space too. Where they do not, the overlap is
doubled until they do.

Texts of ordinary length are cut before white space that follows something else (no pre-token spans such a
place from the left, and none depends on what is to the right of it), and each distinct piece is encoded once for
as long as a worker remembers it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab

#: Texts of more characters than this are counted in overlapping chunks.
HUGE = 1 << 14
OVERLAP = 256
#: Longer than contractions and special strings.
MARGIN = 24


def _starts(spans: list[tuple[int, int]], base: int) -> dict[int, int]:
    """Position -> token, for tokens that start between two characters (bytes of one share its span)."""
    out, last = {}, 0
    for k, (a, b) in enumerate(spans):
        if a >= last and b > a:
            out[a + base] = k
        last = max(last, b)
    return out


def count_huge(text: str, path: str, chunk: int = HUGE, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``.

    Memory is that of two chunks and what they overlap, wherever two encodings agree on one token in a chunk. Where they
    agree on none (we know of no such text) the next chunk is encoded with the last one, and neither is cut short.
    """
    t = vocab.tokenizer(path)

    def encoded(a: int, b: int):
        e = t.encode(text[a:b], add_special_tokens=False)
        return e.ids, _starts(e.offsets, a)

    total, end = 0, min(chunk, len(text))
    ids, starts = encoded(0, end)
    while end < len(text):
        wide, splice, first = overlap, None, min(starts)
        while splice is None:
            a = max((s for s in starts if s <= end - wide), default=first)
            b = min(len(text), end + chunk)
            new_ids, new_starts = encoded(a, b)
            splice = next((s for s in new_starts if a + MARGIN <= s <= end - MARGIN and s in starts and ids[starts[s]] == new_ids[new_starts[s]]), None)
            if splice is None:
                if a == first:  # all of the last chunk overlaps: carry on with one longer chunk
                    break
                wide *= 2
        if splice is None:
            ids, starts = new_ids, new_starts
        else:
            total += starts[splice]
            keep = new_starts[splice]
            ids, starts = new_ids[keep:], {s: k - keep for s, k in new_starts.items() if k >= keep}
        end = b
    return total + len(ids)


def count_texts(texts: list[str | None], path: str, huge: int = HUGE) -> list[int]:
    """Tokens of each text, as the library counts them for the whole text; null counts as empty."""
    out = [0] * len(texts)
    plain = [i for i, t in enumerate(texts) if t and len(t) <= huge]
    for a in range(0, len(plain), 256):
        part = plain[a : a + 256]
        for i, counts in zip(part, vocab.memory(path, "count").each([vocab.SPACE.split(texts[i]) for i in part]), strict=True):
            out[i] = sum(counts)
    for i, t in enumerate(texts):
        if t and len(t) > huge:
            out[i] = count_huge(t, path, huge)
    return out


def token_counts(docs: DataFrame, path: str, limit: int, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), ``out`` and over_limit (more than ``limit`` tokens).

    Counts are the library's for the whole text, without added tokens; strings of special tokens in a
    text are handled as the library does by default. Null and empty texts have 0 of each. Rows are
    neither dropped nor merged; existing columns with the new names are replaced.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(count_texts(texts.tolist(), path), dtype="int64")

    text = F.col(text_col)
    counted = docs.withColumn(out, F.pandas_udf(run, "long")(text))
    return counted.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "over_limit": F.col(out) > limit})
