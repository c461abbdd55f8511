"""Pack tokenised documents into fixed-length sequences: first-fit decreasing in randomised groups.

A document's ids (with a closing id) are cut into full sequences and one rest. All pieces are dealt at random into groups
of a bounded number of pieces; every group is packed on its own, longest piece first, each into the first open sequence
with room, found by descending a tournament tree whose nodes hold the largest room below them. Groups are independent
tasks, so their number grows with the corpus and nothing else does.

Defined cases: null text counts as empty, and an empty document is its closing id alone; repeated rows are packed as often
as they occur; a null id is carried through; ids that occur in several rows may not be told apart in the result. Pieces of equal length
are packed in the order of their group; an empty table gives an empty one. Other columns are passed through, whatever their names; one
with the name of a result gives way.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offerlake.llm.common import held, map_text, staged

LENGTH = 2048
#: Pieces of a group on average.
GROUP_PIECES = 4096
#: Distinct runs in the young generation of known ids (speed only).
KEPT_WORDS = 400_000
#: Marks that may be cut off behind a letter (fixed value).
MARKS = b"!#$%&()*,./:;?@[]_|-"


class WordTokens(dict):
    """Ids (little-endian 32 bit) of runs of text between ASCII white space, by a tokenizer whose tokens never span white
    space and that lower-cases.

    Each distinct run is encoded once and looked up from then on. Known runs are held in two generations: when the young
    one is full it becomes the old one, so frequent runs stay and memory is bounded.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.old: dict[bytes, bytes] = {}
        # a tokenizer that hands a-z on as they are, in one piece, gives what its model gives for a run of them
        letters = "abcdefghijklmnopqrstuvwxyz"
        text = self.tok.normalizer.normalize_str(letters) if self.tok.normalizer else letters
        cut = [piece for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)] if self.tok.pre_tokenizer else [text]
        added = any(t.content.isalpha() for t in self.tok.get_added_tokens_decoder().values())
        self.model = self.tok.model if cut == [letters] and not added else None

    def __missing__(self, run: bytes) -> bytes:
        ids = self.old.get(run)
        if ids is None:
            head = run.rstrip(MARKS)
            if b"<" in run or not head:
                ids = self._encoded(run)
            elif run.isascii() and (low := run.lower()) != run:
                ids = self[low]
            elif head != run and head[-1:].isalpha():
                # behind an ASCII letter, trailing ASCII marks are always a token run of their own
                ids = self[head] + self[run[len(head):]]
            else:
                ids = self._encoded(run)
        self[run] = ids
        return ids

    def _encoded(self, run: bytes) -> bytes:
        if self.model is not None and run.isalpha() and run.islower():
            ids = array("I", [t.id for t in self.model.tokenize(run.decode())])
        else:
            ids = array("I", self.tok.encode(run.decode(), add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > KEPT_WORDS:
            self.old = dict(self)
            self.clear()
        return [b"".join(map(self.__getitem__, t.encode("utf-8", "replace").split())) for t in texts]


def tokenizer(path: str) -> WordTokens:
    return held(("words", path), lambda: WordTokens(path))


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    return tokenizer(path).encode(texts)


def pieces(df: DataFrame, path: str, end_id: int = 1, length: int = LENGTH, text: str = "text", ids: bool = False) -> DataFrame:
    """Tokenise and cut: adds doc_tokens and ``pieces`` (start, length, crc32 of the ids, on request the ids); drops the text."""
    end = np.array([end_id], "<u4").tobytes()
    kind = "struct<start:long,length:long,ids_crc32:long" + (",ids:array<int>>" if ids else ">")

    def run(part: pa.RecordBatch) -> dict:
        texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
        total, cut = [], []
        for b in token_bytes(texts, path):
            b += end
            total.append(len(b) // 4)
            mine = []
            for s in range(0, len(b), 4 * length):
                p = b[s:s + 4 * length]
                mine.append({"start": s // 4, "length": len(p) // 4, "ids_crc32": zlib.crc32(p)}
                            | ({"ids": np.frombuffer(p, "<i4")} if ids else {}))
            cut.append(mine)
        return {"doc_tokens": total, "pieces": cut}

    return map_text(df, text, f"doc_tokens long, pieces array<{kind}>", run).drop(text)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece. Pieces above the capacity are an error; ties keep their order."""
    n = len(sizes)
    if n and int(sizes.max()) > capacity:
        raise ValueError("a piece is longer than a sequence")
    leaves = 1 << max(0, int(n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            best = left if left > right else right
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pack(df: DataFrame, size: str = "length", length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Give every row of ``df`` (one piece each) a ``sequence_id`` and an ``offset`` (columns of these names give way). ``df`` must
    be a stored table: its rows are dealt out by a hash of their place in it."""
    groups = max(1, -(-df.count() // group_pieces))
    kept = [c for c in df.columns if c not in ("sequence_id", "offset")]
    dealt = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in"), F.col(f"`{size}`").cast("long").alias("_size"),
                      F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("_group"))

    def run(t: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(t["_size"].to_numpy(), length)
        return pa.table([t["_in"], pa.array(t["_group"][0].as_py() * (1 << 32) + bins), pa.array(offsets)], names=["_in", "sequence_id", "offset"])

    out = StructType([dealt.schema["_in"], *StructType.fromDDL("sequence_id long, offset long").fields])
    packed = dealt.groupBy("_group").applyInArrow(run, out)
    return packed.select(*[F.col("_in").getField(c).alias(c) for c in kept], "sequence_id", "offset")


def pack_documents(df: DataFrame, path: str, end_id: int = 1, length: int = LENGTH, text: str = "text", ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with the other columns of ``df``. A column with the name of a result (``doc_tokens,
    start, length, ids_crc32, sequence_id, offset``, on request ``ids``) gives way."""
    made = ["doc_tokens", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    kept = [c for c in df.columns if c not in (text, *made, "sequence_id", "offset")]
    rows = df.select(*([F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in")] if kept else []), F.col(f"`{text}`").alias("_text"))
    cut = staged(pieces(rows, path, end_id, length, "_text", ids), "pieces")
    inside = ["_in"] if kept else []
    flat = cut.select(*inside, "doc_tokens", F.explode("pieces").alias("p")).select(*inside, "doc_tokens", "p.*")
    return pack(flat, length=length).select(*[F.col("_in").getField(c).alias(c) for c in kept], *made, "sequence_id", "offset")


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """The padded sequences of ``pack_documents(..., ids=True)``: sequence_id and input_ids (array<int>).

    A sequence whose length is a power of two is not padded. A sequence is bounded by ``length`` ids.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        row = np.concatenate([np.asarray(x, np.int32) for x in pdf["ids"]])
        if len(row) & (len(row) - 1):
            row = np.concatenate([row, np.full(length - len(row), pad_id, np.int32)])
        return pd.DataFrame({"sequence_id": [pdf["sequence_id"].iloc[0]], "input_ids": [row]})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(run, "sequence_id long, input_ids array<int>")

