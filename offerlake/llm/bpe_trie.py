"""Byte-level BPE by a prefix-sharing trie.

The words of a block of documents are inserted into a trie (kept as the sorted list of distinct words: its order is the
trie's depth-first order, and the common prefix of neighbours is the path they share). A depth-first walk carries, for
every prefix on the path, the last token of that prefix's encoding. The last token of a longer prefix is the one
vocabulary suffix that is compatible with the last token before it, so a shared prefix is encoded once, and a word's ids
are read off the path backwards.

Two neighbouring tokens are compatible if merging by rank would never join anything across their border. That is found
by undoing the two tokens' merges from the latest to the earliest: at each point in time a merge of the two pieces that
then touch must rank behind the event that ends that point in time.

Defined cases: null text counts as empty (no ids, empty decoded text); repeated rows give repeated results; ids may be
null; other columns are passed through; very long words are walked iteratively, so memory follows one block of rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from offerlake.llm.common import held, map_text

#: The published split pattern of byte-level BPE (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words of the young generation whose ids a worker keeps between blocks (a full one becomes the old one), and border checks
#: it remembers (beyond, it starts over). Speed only.
KEPT_WORDS = 400_000
KEPT_BORDERS = 400_000
NEVER = 1 << 60


#: The same where letters and numbers of newer Unicode versions, {0}, count as marks.
OLDER = r"""'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?!{0})\p{{L}})+| ?(?:(?!{0})\p{{N}})+| ?(?:[^\s\p{{L}}\p{{N}}]|{0})+|\s+(?!\S)|\s+"""


#: Letters and numbers of Unicode 16, which the tokenizers library knows and Python 3.13 does not (fixed values).
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7,
    0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF,
    0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
]


def newer_characters() -> list[list[str]]:
    """Letters and numbers of the ``regex`` module that the tokenizers library's older tables do not assign: [first, last] of every run."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    runs: list[list[str]] = []
    for ch in regex.findall(r"[\p{L}\p{N}]", everything):
        if unicodedata.category(ch) == "Cn" and not any(a <= ord(ch) <= b for a, b in UNICODE_16):
            if runs and ord(runs[-1][1]) == ord(ch) - 1:
                runs[-1][1] = ch
            else:
                runs.append([ch, ch])
    return runs


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBPE:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` format (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        as_bytes = lambda s: bytes(to_byte[c] for c in s)
        model = spec["model"]
        self.text_of = {i: as_bytes(s) for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.text_of.update({i: s.encode() for s, i in self.special.items()})
        id_of = {as_bytes(s): i for s, i in model["vocab"].items() if s not in self.special}
        self.rank: dict[tuple[int, int], int] = {}
        self.born: dict[int, tuple[int, int, int]] = {}  # token -> (rank of its merge, left part, right part)
        for r, m in enumerate(model["merges"]):
            left, right = (as_bytes(x) for x in (m if isinstance(m, list) else m.split(" ")))
            a, b, c = id_of[left], id_of[right], id_of[left + right]
            if (a, b) not in self.rank:
                self.rank[a, b] = r
                self.born.setdefault(c, (r, a, b))
        # only tokens that their own text encodes to can be a last token
        self.token = {s: i for s, i in id_of.items() if len(s) == 1 or i in self.born and self.apart(*self.born[i][1:], self.born[i][0])}
        # the trie of the reversed tokens: (node << 8 | byte) -> node, and the token that ends at a node
        self.back: dict[int, int] = {}
        self.ends = [-1]
        for s, i in self.token.items():
            node = 0
            for byte in reversed(s):
                node = self.back.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        self.borders: dict[int, bool] = {}  # (left token << 32 | right token) -> do they stay apart
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.split = regex.compile(SPLIT)
        newer = newer_characters()
        one_of = "[" + "".join(f"{a}-{b}" for a, b in newer) + "]" if newer else "(?!)"
        self.newer, self.older = re.compile(one_of), regex.compile(OLDER.format(one_of))
        self.high = re.compile(f"[{newer[0][0]}-\U0010ffff]" if newer else "(?!)")
        self.pieces = [self.text_of.get(i, b"") for i in range(max(self.text_of) + 1)]

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """Do tokens a, b stay apart when their joined text is merged by rank (up to, without, rank ``until``)?"""
        from_right = False
        while True:
            r = self.rank.get((a, b), NEVER)
            # the leftmost of equal merges goes first: a tie with the right side's next merge is lost by that merge
            if r < until or (r == until and from_right and r != NEVER):
                return False
            ra, rb = self.born.get(a, (-1,))[0], self.born.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                until, from_right, a = ra, False, self.born[a][2]
            else:
                until, from_right, b = rb, True, self.born[b][1]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids (little-endian 32 bit) of distinct words, by one depth-first walk over their trie."""
        out: dict[str, bytes] = {}
        back, ends, borders, apart = self.back, self.ends, self.borders, self.apart
        last: list[int] = [-1]  # last[i]: last token of the current word's prefix of i bytes
        since: list[int] = [0]  # since[i]: where that token begins
        before = b""
        for raw, text in sorted([(w.encode("utf-8", "surrogatepass"), w) for w in words]):
            top = min(len(before), len(raw))
            depth = 0
            while depth < top and before[depth] == raw[depth]:
                depth += 1
            del last[depth + 1:], since[depth + 1:]
            for i in range(depth, len(raw)):
                node, j = 0, i
                while True:  # the vocabulary's suffixes of raw[:i + 1], shortest first; exactly one is compatible
                    node = back[node << 8 | raw[j]]
                    t = ends[node]
                    if t >= 0:
                        p = last[j]
                        if p < 0:
                            break
                        border = p << 32 | t
                        ok = borders.get(border)
                        if ok is None:
                            if len(borders) >= KEPT_BORDERS:
                                borders.clear()
                            ok = borders[border] = apart(p, t)
                        if ok:
                            break
                    j -= 1
                last.append(t)
                since.append(j)
            ids, i = [], len(raw)
            while i:
                ids.append(last[i])
                i = since[i]
            ids.reverse()
            out[text] = struct.pack(f"<{len(ids)}I", *ids)
            before = raw
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text; the distinct words that are not known yet share one trie."""
        if len(self.words) > KEPT_WORDS:
            self.old, self.words = self.words, {}
        known, old = self.words, self.old
        parts: list[list] = []  # per text its runs: ids, or the words and what is known of them
        fresh: set[str] = set()
        for text in texts:
            mine: list = []
            for k, seg in enumerate(self.marks.split(text) if self.marks and "<|" in text else [text]):
                if k % 2:
                    mine.append(struct.pack("<I", self.special[seg]))
                elif seg:
                    rare = not seg.isascii() and self.high.search(seg) and self.newer.search(seg)
                    words = (self.older if rare else self.split).findall(seg)
                    ids = list(map(known.get, words))
                    try:
                        mine.append(b"".join(ids))
                    except TypeError:  # a word without ids yet
                        fresh.update([w for w, i in zip(words, ids) if i is None])
                        mine.append((words, ids))
            parts.append(mine)
        known.update([(w, old[w]) for w in fresh if w in old])
        known.update(self.encode_words([w for w in fresh if w not in old]))
        return [b"".join([run if isinstance(run, bytes) else b"".join([known[w] if i is None else i for w, i in zip(*run)])
                          for run in mine]) for mine in parts]

    def decode(self, ids: bytes) -> str:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def codec(path: str) -> TrieBPE:
    return held(("bpe", path), lambda: TrieBPE(path))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add column ``ids`` (array<int>) to ``df``."""

    def run(part: pa.RecordBatch) -> dict:
        raw = codec(path).encode([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
        return {ids: [np.frombuffer(b, "<u4").astype("<i4") for b in raw]}

    return map_text(df, text, f"{ids} array<int>", run)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add column ``decoded`` to ``df`` (one of that name gives way); a null array gives null."""

    def run(part: pa.RecordBatch) -> dict:
        rows = part.column(part.schema.get_field_index(ids)).to_pylist()
        return {text: [None if r is None else codec(path).decode(np.array(r, "<u4").tobytes()) for r in rows]}

    from pyspark.sql.types import StringType, StructField, StructType

    out = StructType([*[f for f in df.schema.fields if f.name != text], StructField(text, StringType())])
    names = [f.name for f in out.fields]
    old = [i for i, f in enumerate(df.schema.fields) if f.name != text]

    def over(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in old), pa.array(run(part)[text], pa.string())], names=names)

    return df.mapInArrow(over, out)


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode, then decode; add n_tokens, ids_sha256, decoded_sha256. The text column is not passed on."""

    def run(part: pa.RecordBatch) -> dict:
        c = codec(path)
        raw = c.encode([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return {"n_tokens": [len(b) // 4 for b in raw], "ids_sha256": [sha(b) for b in raw],
                "decoded_sha256": [sha(c.decode(b).encode("utf-8", "replace")) for b in raw]}

    return map_text(df, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", run).drop(text)
