"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

The ids of a text are those of the library. Texts of ordinary length are given to it as they are. A giant
text is normalised and split into chunks, and each chunk yields a *transfer matrix* between boundary
states: which pieces may cross, or end at, the chunk's first boundary, which its last, and the best weight
of a path of pieces between them. Matrices of neighbouring chunks are combined (an associative max-plus
product), which fixes the state at every boundary; each chunk is then backtraced on its own.

For a byte-pair model a path is the library's segmentation exactly if any two neighbouring pieces, taken
alone, are segmented into themselves. So an arc between compatible pieces weighs 0 and any other minus
infinity; a column of the matrix is the set of in-states with weight 0, kept as the bits of an integer.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

GIANT, CHUNK = 1 << 16, 1 << 13
#: Matrices that one task combines: those of a longer text are combined in a tree.
FAN = 64
_SPACE = "▁"
State = tuple[int, int]  # a piece from ``s`` characters before a boundary to ``e`` after it; (0, 0): the start


class Pieces:
    """The model's normal pieces, and which neighbours its merges leave alone."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.longest = max(map(len, self.id))
        self.prefixes = {p[:n] for p in self.id for n in range(1, len(p) + 1)}
        self.known: dict[tuple[str, str], bool] = {}
        self.among: dict[tuple[str, ...], dict[str, list[str]]] = {}

    def merge(self, text: str) -> list[str]:
        """Byte-pair merges of a short text: best score first, then leftmost."""
        part: list[str | None] = list(text)
        n = len(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list = []

        def push(a: int) -> None:
            if a >= 0 and right[a] < n and (both := part[a] + part[right[a]]) in self.score:
                heappush(heap, (-self.score[both], a, both))

        for a in range(n):
            push(a)
        while heap:
            _, a, both = heappop(heap)
            if part[a] is None or right[a] >= n or part[a] + part[right[a]] != both:
                continue
            gone = right[a]
            part[a], part[gone], right[a] = both, None, right[gone]
            if right[a] < n:
                left[right[a]] = a
            push(left[a])
            push(a)
        return [p for p in part if p is not None]

    def fit(self, a: str, b: str) -> bool:
        """Whether pieces ``a`` and ``b`` may stand side by side (``a`` empty: ``b`` comes first)."""
        key = (a, b)
        if key not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[key] = self.merge(a + b) == ([a, b] if a else [b])
        return self.known[key]

    def fitting(self, ended: dict) -> Callable[[str], list[str]]:
        """Piece -> those of ``ended`` that it may follow; remembered, as runs of one sign end alike everywhere."""
        key = tuple(ended)
        if key not in self.among:
            if len(self.among) > 50_000:
                self.among.clear()
            self.among[key] = {}
        found = self.among[key]

        def before(piece: str) -> list[str]:
            if piece not in found:
                found[piece] = [x for x in key if self.fit(x, piece)]
            return found[piece]

        return before

    def starting(self, text: str, at: int) -> Iterator[str]:
        """Pieces that ``text`` has at ``at``; a character outside the model stands alone."""
        for n in range(1, min(self.longest, len(text) - at) + 1):
            piece = text[at : at + n]
            if piece in self.id or n == 1:
                yield piece
            if piece not in self.prefixes:
                return

    def ids(self, piece: str) -> list[int]:
        """Of a piece; a character outside the model is its bytes, or the unknown id."""
        if piece in self.id:
            return [self.id[piece]]
        sp = self.library
        found = [sp.piece_to_id(f"<0x{x:02X}>") for x in piece.encode("utf-8", "surrogatepass")]
        return found if all(sp.is_byte(i) for i in found) else [sp.unk_id()]


@lru_cache(maxsize=2)
def model(path: str) -> Pieces:
    return Pieces(path)


def _in_states(m: Pieces, text: str, b: int) -> list[State]:
    """Every piece of the text that crosses or ends at ``b``; at its start the one empty state."""
    if b == 0:
        return [(0, 0)]
    return [(b - s, s + len(p) - b) for s in range(max(0, b - m.longest), b) for p in m.starting(text, s) if s + len(p) >= b]


def transfer(m: Pieces, text: str, b0: int, b1: int) -> dict[State, dict[State, float]]:
    """{out-state: {in-state: weight}} from ``b0`` to ``b1``; ``text`` has a margin on either side."""
    first = _in_states(m, text, b0)
    live: dict[int, dict[str, int]] = {}
    out: dict[State, int] = {}
    for i, (s, e) in enumerate(first):
        if b0 + e >= b1 and (s or e):
            out[(b1 - b0 + s, b0 + e - b1)] = 1 << i
        else:
            here = live.setdefault(b0 + e, {})
            piece = text[b0 - s : b0 + e]
            here[piece] = here.get(piece, 0) | 1 << i
    for at in range(b0, b1):
        ended = live.pop(at, None)
        if not ended:
            continue
        fitting = m.fitting(ended)
        for piece in m.starting(text, at):
            bits = 0
            for before in fitting(piece):
                bits |= ended[before]
            if bits:
                end = at + len(piece)
                if end >= b1:
                    out[(b1 - at, end - b1)] = out.get((b1 - at, end - b1), 0) | bits
                else:
                    here = live.setdefault(end, {})
                    here[piece] = here.get(piece, 0) | bits
    return {o: {first[i]: 0.0 for i in range(len(first)) if bits >> i & 1} for o, bits in out.items()}


def combine(a: dict, b: dict) -> dict:
    """Max-plus product: from the in-states of ``a`` to the out-states of ``b``."""
    out: dict = {}
    for o, column in b.items():
        best: dict = {}
        for mid, w in column.items():
            for i, v in a.get(mid, {}).items():
                if v + w > best.get(i, float("-inf")):
                    best[i] = v + w
        if best:
            out[o] = best
    return out


def boundary_states(matrices: list[dict], first: State = (0, 0), last: State | None = None) -> list[State]:
    """The state at every boundary on the best path from ``first`` to ``last`` (without it: to the end of the text)."""
    reached, prefix = [], None
    for mat in matrices:
        prefix = mat if prefix is None else combine(prefix, mat)
        prefix = {o: {first: c[first]} for o, c in prefix.items() if first in c}
        reached.append(prefix)
    state = last if last is not None else max((o for o in prefix if o[1] == 0), key=lambda o: prefix[o][first])
    states = [state]
    for k in range(len(matrices) - 1, 0, -1):
        column = matrices[k][state]
        state = max((i for i in column if i in reached[k - 1]), key=lambda i: column[i] + reached[k - 1][i][first])
        states.append(state)
    return [first, *reversed(states)]


def backtrace(m: Pieces, text: str, b0: int, b1: int, first: State, last: State) -> list[str]:
    """The pieces that start in the chunk, between its two boundary states."""
    start = b0 + first[1]
    if start >= b1:
        return []
    live = {start: {text[b0 - first[0] : start]: None}}
    for at in range(start, b1):
        ended = live.get(at)
        if not ended:
            continue
        fitting = m.fitting(ended)
        for piece in m.starting(text, at):
            if before := fitting(piece):
                live.setdefault(at + len(piece), {})[piece] = before[0]
    at, piece, out = b1 + last[1], text[b1 - last[0] : b1 + last[1]], []
    while at > start:
        out.append(piece)
        before = live[at][piece]
        at -= len(piece)
        piece = before
    return out[::-1]


def _chunks(path: str, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for rows in batches:
            for row, text in zip(rows["row"].tolist(), rows["text"], strict=True):
                text = m.library.normalize(text)
                n = max(1, -(-len(text) // size))
                for k in range(n):
                    a, b = k * size, min(len(text), (k + 1) * size)
                    lo = max(0, a - m.longest)
                    yield pd.DataFrame({"row": [row], "k": [k], "b0": [a - lo], "b1": [b - lo], "part": [text[lo : b + m.longest]]})

    return run


def _coded(matrix: dict) -> str:
    return json.dumps([[o, [[i, w] for i, w in c.items()]] for o, c in matrix.items()])


def _decoded(text: str) -> dict:
    return {tuple(o): {tuple(i): w for i, w in c} for o, c in json.loads(text)}


def _matrices(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for rows in batches:
            made = [_coded(transfer(m, t, a, b)) for t, a, b in zip(rows["part"], rows["b0"].tolist(), rows["b1"].tolist(), strict=True)]
            yield pd.DataFrame({"row": rows["row"], "k": rows["k"], "matrix": made})

    return run


def _product(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The matrix of neighbouring chunks together."""
    made = reduce(combine, map(_decoded, rows.sort_values("k")["matrix"]))
    return pd.DataFrame({"row": [key[0]], "k": [key[1]], "matrix": [_coded(made)]})


def _states(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """States at both ends of each chunk, between those of the chunks together (s0 null: the text's start and end)."""
    rows = rows.sort_values("k")
    outer = rows[["s0", "e0", "s1", "e1"]].iloc[0]
    ends = ((0, 0), None) if pd.isna(outer["s0"]) else ((int(outer["s0"]), int(outer["e0"])), (int(outer["s1"]), int(outer["e1"])))
    s = boundary_states([_decoded(x) for x in rows["matrix"]], *ends)
    return pd.DataFrame({"row": rows["row"].to_numpy(), "k": rows["k"].to_numpy(), "s0": [x[0] for x in s[:-1]], "e0": [x[1] for x in s[:-1]], "s1": [x[0] for x in s[1:]], "e1": [x[1] for x in s[1:]]})


def _all_states(matrices: DataFrame, chunks: int, fan: int) -> DataFrame:
    """(row, k, s0, e0, s1, e1) of every chunk: up the tree of products, and down again with the states.

    No task holds more than ``fan`` matrices. ``chunks``: most chunks of a text.
    """
    levels = [matrices]
    while chunks > fan:
        up = levels[-1].groupBy("row", F.floor(F.col("k") / fan).cast("int").alias("k2")).applyInPandas(_product, "row long, k int, matrix string")
        levels.append(common.cut(up))
        chunks = -(-chunks // fan)
    ends = ("s0", "e0", "s1", "e1")
    states = None
    for level in reversed(levels):
        if states is None:
            level = level.withColumns({"up": F.lit(0), **{x: F.lit(None).cast("int") for x in ends}})
        else:
            level = level.withColumn("up", F.floor(F.col("k") / fan).cast("int")).join(states.withColumnRenamed("k", "up"), ["row", "up"])
        states = level.groupBy("row", "up").applyInPandas(_states, "row long, k int, s0 int, e0 int, s1 int, e1 int")
    return states


def _traced(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                pieces = backtrace(m, r.part, r.b0, r.b1, (r.s0, r.e0), (r.s1, r.e1))
                out.append(np.array([i for p in pieces for i in m.ids(p)], np.int32))
            yield pd.DataFrame({"row": rows["row"], "k": rows["k"], "ids": out})

    return run


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", giant: int = GIANT, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """``docs`` with ``out``: the library's ids of the whole text, without begin and end ids.

    Texts of more than ``giant`` characters go through the parallel scan, in chunks of ``chunk``
    characters that any task can work on. Null and empty texts have no ids. Rows are neither dropped nor
    merged, and may repeat; an existing column named ``out`` is replaced.
    """
    row, text = common.spare(docs, "row"), F.coalesce(F.col(text_col), F.lit(""))
    huge = F.length(text) > giant

    def plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model(path)
        for texts in batches:
            found: list = []
            for a in range(0, len(texts), 64):
                found += [np.array(ids, np.int32) for ids in m.library.encode(texts.iloc[a : a + 64].tolist(), num_threads=1)]
            yield pd.Series(found)

    base = docs.drop(out)
    short = base.where(~huge).withColumn(out, F.pandas_udf(plain, "array<int>")(text))
    # giant texts are few: their rows are kept as they are, so that the numbers stay with them
    few = common.cut(base.where(huge).withColumn(row, F.monotonically_increasing_id()))
    parts = few.select(F.col(row).alias("row"), F.col(text_col).alias("text")).mapInPandas(_chunks(path, chunk), "row long, k int, b0 int, b1 int, part string")
    parts = common.cut(parts)
    size = parts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("k"), F.lit(0)).alias("most")).first()
    parts = common.cut(parts.repartition(max(1, -(-size["n"] // 8)), "row", "k"))  # some 8 chunks a task
    states = _all_states(common.cut(parts.mapInPandas(_matrices(path), "row long, k int, matrix string")), size["most"] + 1, fan)
    traced = parts.join(states, ["row", "k"]).repartition(max(1, -(-size["n"] // 8)), "row", "k").mapInPandas(_traced(path), "row long, k int, ids array<int>")
    ids = traced.groupBy("row").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias(out))
    return short.unionByName(few.join(ids.withColumnRenamed("row", row), row).drop(row))


def decode_ids(ids, path: str, step: int = 1 << 14) -> str:
    """The text of a list of ids, as the library decodes it; worked on in parts that end between characters."""
    m = model(path)
    ids = np.asarray(ids).tolist()
    if len(ids) <= step:
        return m.library.decode(ids)
    out, at = [], 0
    while at < len(ids):
        end = min(len(ids), at + step)
        while end < len(ids) and (m.library.is_byte(ids[end]) or m.library.is_byte(ids[end - 1])):
            end += 1  # bytes belong together
        # an id before the part keeps its first space, which only a text's own first piece loses
        guard = m.id["a"]
        text = m.library.decode([guard, *ids[at:end]])[1:] if at else m.library.decode(ids[at:end])
        out.append(text)
        at = end
    return "".join(out)


def decode(coded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with ``out``: the text of the ids, as the library decodes them. Null ids give ""."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in batches:
            yield pd.Series([decode_ids(x, path) if x is not None else "" for x in lists], dtype=object)

    return coded.withColumn(out, F.pandas_udf(run, "string")(F.col(ids_col)))


def digest(coded: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """(id_col, n_tokens, ids_crc32, round_trip, ids, decoded): the ids, in short too, and whether decoding gives the text back."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lists, texts in batches:
            crc, back = [zlib.crc32(np.asarray(x, "<u4")) for x in lists], [decode_ids(x, path) for x in lists]
            yield pd.DataFrame({"crc": crc, "same": [b == t for b, t in zip(back, texts, strict=True)], "decoded": back})

    # one pass of Python over the ids for all
    made = F.pandas_udf(run, "crc long, same boolean, decoded string")(F.col(ids_col), F.coalesce(F.col(text_col), F.lit("")))
    known = coded.select(id_col, ids_col, F.size(ids_col).cast("long").alias("n_tokens"), made.alias("made"))
    return known.select(id_col, "n_tokens", F.col("made.crc").alias("ids_crc32"), F.col("made.same").alias("round_trip"), F.col(ids_col).alias("ids"), F.col("made.decoded").alias("decoded"))
