"""Align the tokens of two tokenizers over the same bytes by divide and conquer at shared cuts.

A cut is a byte offset at which a token of either side ends. Within an interval of tokens the common end next to the middle is
located by bisecting the other side's ends, outward from the middle; both halves are then treated alike, and an interval
without a cut is a leaf: a group. Every candidate end is tried once, whatever the shape of the recursion, and all open intervals
of many texts take their steps side by side.

Neither tokenizer joins anything across a border between a non-space and a space (checked for the vocabulary when it is
loaded; a text is one run where it does not hold). Such borders are shared cuts, so a text falls into runs, and a distinct run
is encoded and divided once in a block: a document's groups are those of its runs, one after the other.

How many documents hold a pair of ids linked is counted over the whole corpus: documents are kept in blocks; a block asks for
its distinct pairs with the number of its documents that hold them. These requests are summed per pair (partially before the
shuffle; a pair occurs once in a block, so no key is hot), the largest count per A id is joined to them, and the answers go back
to the blocks, which add them up per document. No document's links are expanded into rows.

Defined cases: a null or empty text, and one whose joined bytes on either side differ from a space and the text (the second side
reads U+2581 as a space), has no tokens: zeros, ``groups_sha256`` ''. Repeated rows are documents of their own and are counted
as such; ids may be null or repeated. Ties for an A id's highest count all are best. An empty table gives an empty one. Long texts
are cut nowhere; memory follows one block (``BLOCK_CHARS``, or one text) and the distinct pairs of its largest group. Other
columns are passed through; one with the name of a result gives way.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offerlake.llm.bpe_trie import byte_alphabet
from offerlake.llm.common import held, pack, slices, staged, unpack

#: Bytes of text and documents of a block, about (a block ends behind the slice that reaches one of them).
BLOCK_CHARS = 8_000_000
BLOCK_ROWS = 50_000
#: Runs that are handed to the tokenizers at once, and pairs of documents that are sorted at once.
ENCODED_AT_ONCE = 20_000
PAIRS_AT_ONCE = 4_000_000
#: Links of a group that are written out one by one; beyond, its distinct ids are counted first.
WIDE_GROUP = 4096
EMPTY = np.zeros(0, np.int64)
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def located(ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Bisect: the first of the ascending ``ends`` that is not below each ``wanted`` one."""
    return np.searchsorted(ends, wanted)


def shared_cuts(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of the tokens of both sides that end at the same offset, ascending.

    ``a`` and ``b`` are the tokens' end offsets, strictly ascending, of many stretches one after the other; each has
    ``sizes_a`` and ``sizes_b`` tokens that end together. All open intervals take their next step at once.
    """
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    cut_a, cut_b = [ends_a - 1], [ends_b - 1]
    # an interval: its tokens [lo, hi), and of its inner ends those at [p, q) that may still be cuts
    lo, hi = ends_a - sizes_a, ends_a
    todo = np.stack([lo, hi, lo, hi - 1])[:, (sizes_a > 1) & (sizes_b > 1)]
    left, right = _beside_the_middle(todo)
    while todo.shape[1]:
        lo, hi, p, q = todo
        middle = left + right  # twice the middle at first; the two sides take turns around it
        at = np.where((right >= q) | ((left >= p) & (middle % 2 == 1)), left, right)
        j = located(b, a[at])
        hit = b[np.minimum(j, len(b) - 1)] == a[at]
        cut_a.append(at[hit])
        cut_b.append(j[hit])
        # without a cut: on to the next candidate, outward; what was tried is not tried again
        goes_left = at == left
        next_left, next_right = np.where(goes_left, left - 1, left), np.where(goes_left, right, right + 1)
        open_ = ~hit & ((next_left >= p) | (next_right < q))
        halves = []
        for h_lo, h_hi, h_p, h_q in ((lo, at + 1, p, np.minimum(next_left + 1, at)), (at + 1, hi, np.maximum(next_right, at + 1), q)):
            some = hit & (h_p < h_q)
            halves.append(np.stack([h_lo, h_hi, h_p, h_q])[:, some])
        halves_ = np.concatenate(halves, 1)
        new_left, new_right = _beside_the_middle(halves_)
        todo = np.concatenate([todo[:, open_], halves_], 1)
        left = np.concatenate([next_left[open_], new_left])
        right = np.concatenate([next_right[open_], new_right])
    i, j = np.concatenate(cut_a), np.concatenate(cut_b)
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


def _beside_the_middle(todo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidate next to an interval's middle, and the one after it."""
    lo, hi, p, q = todo
    middle = np.minimum(np.maximum((lo + hi - 1) // 2, p), q - 1)
    return middle, middle + 1


class Learnt(NamedTuple):
    """What distinct runs add to a document: A tokens, B tokens, groups, links; the groups as text (None: the bytes differ); how
    many pairs are linked, and those of all runs one after the other with the number of times."""

    own: np.ndarray
    texts: list[str | None]
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def taken(parts: list[Learnt], at: np.ndarray) -> Learnt:
    """The runs numbered ``at`` of several ``Learnt`` one after the other."""
    own, n_pairs = np.concatenate([p.own for p in parts]), np.concatenate([p.n_pairs for p in parts])
    texts = [t for p in parts for t in p.texts]
    begin, size = (np.cumsum(n_pairs) - n_pairs)[at], n_pairs[at]
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    pairs, times = (np.concatenate([getattr(p, c) for p in parts])[place] for c in ("pairs", "times"))
    return Learnt(own[at], [texts[i] for i in at.tolist()], size, pairs, times)


def _joined(pieces: list[bytes], ids: list[int] | np.ndarray) -> bytes:
    return b"".join([pieces[i] for i in (ids if isinstance(ids, list) else ids.tolist())])


class Aligner:
    """Both tokenizers with their tokens' bytes, and what the last block's runs added."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        self.bytes_a = [special[i] if i in special else bytes(to_byte[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(s[1:-1], 16)]) if self.b.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(pieces)]
        before = spec.get("pre_tokenizer") or {}
        self.apart = (spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                      and not any("▁" in s.lstrip("▁") for s in pieces))
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.last: tuple[dict[str, int], Learnt] = {}, Learnt(np.zeros((0, 4), np.int64), [], EMPTY, EMPTY, EMPTY)
        self.digits = np.array([f"{i:\0<{len(str(most))}}".encode() for i in range(most)], f"S{len(str(most))}").view(np.uint8).reshape(most, -1)

    def runs(self, text: str) -> list[str]:
        """`` `` + text, cut before every space that follows something other than white space (but for one that ends the text)."""
        if not self.apart:
            return [" " + text]
        out: list[str] = []
        joins = False
        for s in text.split(" "):
            if joins:
                out[-1] += " " + s
            else:
                out.append(" " + s)
            joins = not s or s[-1].isspace()
        if len(out) > 1 and out[-1] == " ":  # nothing but the space that the second tokenizer adds by itself
            out[-2:] = [out[-2] + " "]
        return out

    def learn(self, runs: list[str]) -> Learnt:
        """What each of the distinct ``runs`` adds to a document."""
        # runs that end in something other than white space stay apart when they are joined: one call for all of them
        plain = [r for r in runs if not r[-1].isspace()] if self.apart else []
        made = self._together(plain)
        if made is not None and len(plain) == len(runs):
            return made
        if made is None:
            return self._one_by_one(runs)
        rest = self._one_by_one([r for r in runs if r[-1].isspace()])
        last = np.array([r[-1].isspace() for r in runs])
        return taken([made, rest], np.where(last, len(plain) + np.cumsum(last) - 1, np.cumsum(~last) - 1))

    def block(self, runs: list[str]) -> Learnt:
        """``learn`` for a block's distinct runs; those of the worker's last block are known."""
        number, known = self.last
        fresh = [r for r in runs if r not in number]
        made = [known, *(self.learn(fresh[i:i + ENCODED_AT_ONCE]) for i in range(0, len(fresh), ENCODED_AT_ONCE))]
        new = dict(zip(fresh, range(len(number), len(number) + len(fresh)), strict=True))
        out = taken(made, np.array([new[r] if r in new else number[r] for r in runs], np.int64))
        self.last = dict(zip(runs, range(len(runs)), strict=True)), out
        return out

    def _together(self, runs: list[str]) -> Learnt | None:
        """``_one_by_one`` for runs that both tokenizers keep apart; None if they turn out not to, or bytes differ."""
        if not runs:
            return None
        text = "".join(runs)
        a = np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(text[1:]), np.int64)
        whole = text.encode()
        if not (_joined(self.bytes_a, a) == _joined(self.bytes_b, b) == whole):
            return None
        ends = np.cumsum(np.asarray(pc.binary_length(pa.array(runs, pa.string())), np.int64))
        n_a, n_b = (np.searchsorted(e, ends) for e in (np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])))
        if not (np.cumsum(self.size_a[a])[n_a] == ends).all() or not (np.cumsum(self.size_b[b])[n_b] == ends).all():
            return None
        return self._aligned(a, b, np.diff(n_a, prepend=-1), np.diff(n_b, prepend=-1))

    def _one_by_one(self, runs: list[str]) -> Learnt:
        a = [e.ids for e in self.a.encode_batch_fast(runs, add_special_tokens=False)]
        b = self.b.encode([r[1:] for r in runs], num_threads=1)
        good = np.array([_joined(self.bytes_a, x) == _joined(self.bytes_b, y) == r.encode() for r, x, y in zip(runs, a, b, strict=True)], bool)
        flat = lambda ids: np.fromiter(chain.from_iterable(i for i, g in zip(ids, good.tolist(), strict=True) if g), np.int64)
        count = lambda ids: np.fromiter(map(len, ids), np.int64, len(ids))[good]
        made = self._aligned(flat(a), flat(b), count(a), count(b))
        # runs whose bytes differ have no text and add nothing
        nothing = Learnt(np.zeros((1, 4), np.int64), [None], np.zeros(1, np.int64), EMPTY, EMPTY)
        return taken([made, nothing], np.where(good, np.cumsum(good) - 1, good.sum()))

    def _aligned(self, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Learnt:
        """Groups and links of runs, of ``n_a`` and ``n_b`` tokens each, whose tokens cover the same bytes."""
        n_runs = len(n_a)
        if not n_runs:
            return Learnt(np.zeros((0, 4), np.int64), [], EMPTY, EMPTY, EMPTY)
        i, j = shared_cuts(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]), n_a, n_b)
        in_a, in_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)  # tokens of a group
        last = np.searchsorted(i, np.cumsum(n_a) - 1)  # a run's last group
        n_groups = np.diff(last, prepend=-1)
        of_run = np.repeat(np.arange(n_runs), n_groups)
        links = np.zeros(n_runs, np.int64)
        np.add.at(links, of_run, in_a * in_b)
        # every A token of a group meets every B token of it; a group with many of both goes by distinct ids
        few = in_a * in_b <= WIDE_GROUP
        start_a, start_b = i + 1 - in_a, j + 1 - in_b
        size = np.where(few, in_a * in_b, 0)
        group = np.repeat(np.arange(len(i)), size)
        within = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
        pairs = ids_a[start_a[group] + within // in_b[group]] * len(self.bytes_b) + ids_b[start_b[group] + within % in_b[group]]
        times = np.ones(len(pairs), np.int64)
        run = of_run[group]
        if not few.all():
            more = [(pairs, times, run)]
            for k in np.flatnonzero(~few).tolist():
                x, x_times = np.unique(ids_a[start_a[k]:i[k] + 1], return_counts=True)
                y, y_times = np.unique(ids_b[start_b[k]:j[k] + 1], return_counts=True)
                more.append(((x[:, None] * len(self.bytes_b) + y).ravel(), (x_times[:, None] * y_times).ravel(), np.full(len(x) * len(y), of_run[k])))
            pairs, times, run = (np.concatenate(c) for c in zip(*more, strict=True))
            order = np.argsort(run, kind="stable")
            pairs, times, run = pairs[order], times[order], run[order]
        return Learnt(np.stack([n_a, n_b, n_groups, links], 1), self._texts(ids_a, ids_b, in_a, in_b, last), np.bincount(run, minlength=n_runs), pairs, times)

    def _texts(self, ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, last: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2`` of every run: all tokens in the order of the text, each with the mark that follows it."""
        before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        n = len(ids_a) + len(ids_b)
        ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[np.arange(len(ids_a)) + np.repeat(before_b, in_a)] = ids_a
        ids[np.arange(len(ids_b)) + np.repeat(before_a + in_a, in_b)] = ids_b
        ends = before_a + before_b + in_a + in_b
        mark[ends - in_b - 1], mark[ends - 1] = ord("|"), ord(";")
        rows = np.concatenate([self.digits[ids], mark[:, None]], 1)
        text = rows[rows != 0].tobytes().decode("ascii")
        at = np.cumsum((rows != 0).sum(1))[ends[last] - 1].tolist()
        return [text[s:e - 1] for s, e in zip([0, *at[:-1]], at, strict=True)]


def runs_of(texts: pa.Array, aligner: Aligner) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(Runs of each text, their numbers one text after the other, the distinct runs by number); null and empty texts have none."""
    docs = np.flatnonzero(np.asarray(pc.fill_null(pc.binary_length(texts), 0)) > 0)
    some = texts.take(pa.array(docs))
    if aligner.apart:
        lists = pc.split_pattern(some, " ")
        sizes, coded = np.asarray(lists.value_lengths(), np.int64), lists.flatten().dictionary_encode()
        codes, runs = np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()
        # a part that is empty or ends in white space belongs to the next one: such texts are cut one by one
        odd = np.array([not r or r[-1].isspace() for r in runs], bool)
        runs = [" " + r for r in runs]
    else:
        sizes, coded = np.ones(len(docs), np.int64), some.dictionary_encode()
        codes, runs = np.asarray(coded.indices, np.int64), [" " + r for r in coded.dictionary.to_pylist()]
        odd = np.zeros(len(runs), bool)
    of = np.repeat(np.arange(len(docs)), sizes)
    apart = np.unique(of[odd[codes]]) if odd.any() else EMPTY
    if len(apart):
        number = {r: i for i, r in enumerate(runs)}
        mine = [[number.setdefault(r, len(number)) for r in aligner.runs(t)] for t in some.take(pa.array(apart)).to_pylist()]
        keep = ~np.isin(of, apart)
        of = np.concatenate([of[keep], np.repeat(apart, [len(m) for m in mine])])
        codes = np.concatenate([codes[keep], np.fromiter(chain.from_iterable(mine), np.int64)])
        order = np.argsort(of, kind="stable")
        of, codes, runs = of[order], codes[order], list(number)
        used, codes = np.unique(codes, return_inverse=True)
        runs = [runs[i] for i in used.tolist()]
    return np.bincount(docs[of], minlength=len(texts)), codes, runs


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often they occur."""
    x = np.sort(x)
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else EMPTY
    return x[first], np.diff(np.append(first, len(x)))


def figures(texts: pa.Array, aligner: Aligner, whole: bool) -> dict[str, pa.Array]:
    """The documents' own figures, and on the first row what their block asks for and adds up later."""
    docs = len(texts)
    sizes, flat, runs = runs_of(texts, aligner)
    learnt = aligner.block(runs)
    n_runs = len(runs)
    text = pa.array(learnt.texts, pa.large_string())
    ends = np.concatenate([[0], np.cumsum(sizes)])
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), text.take(pa.array(flat))), pa.scalar(";", pa.large_string()))
    good = np.asarray(groups.is_valid()) & (sizes > 0)  # no run of the text has bytes that differ
    at = np.frombuffer(groups.buffers()[1], np.int64, docs + 1, groups.offset * 8).tolist()
    data = memoryview(groups.buffers()[2] or b"")
    shas = [hashlib.sha256(data[s:e]).hexdigest() if g else "" for s, e, g in zip(at, at[1:], good.tolist(), strict=False)]
    flat, sizes = flat[np.repeat(good, sizes)], np.where(good, sizes, 0)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    total = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(learnt.own[flat], 0)])
    own = total[ends[1:]] - total[ends[:-1]]
    del total
    # distinct runs of a document
    both, times = _distinct(np.repeat(np.arange(docs), sizes) * max(1, n_runs) + flat)
    doc, flat = np.divmod(both, max(1, n_runs))
    # distinct pairs of the block, from the runs of documents that have tokens
    n_pairs = learnt.n_pairs
    used = np.zeros(n_runs, bool)
    used[flat] = True
    some = np.repeat(used, n_pairs)
    codes, pairs = pd.factorize(learnt.pairs[some])
    order = np.argsort(pairs)
    rank = np.empty(len(pairs), np.int64)
    rank[order] = np.arange(len(pairs))
    pairs, pair_at = pairs[order], rank[codes]
    of_run = learnt.times[some]
    n_pairs = np.where(used, n_pairs, 0)
    # documents of the block that hold a pair: each document's pairs once, some documents at a time
    begin = np.cumsum(n_pairs) - n_pairs
    expanded = np.concatenate([[0], np.cumsum(n_pairs[flat])])
    holders = np.zeros(len(pairs), np.int64)
    first_of = np.searchsorted(doc, np.arange(docs + 1))
    lo = 0
    while lo < docs:
        hi = max(lo + 1, int(np.searchsorted(expanded[first_of], expanded[first_of[lo]] + PAIRS_AT_ONCE, "right")) - 1)
        mine, of = flat[first_of[lo]:first_of[hi]], doc[first_of[lo]:first_of[hi]]
        k = n_pairs[mine]
        place = np.repeat(begin[mine] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        held_by, _ = _distinct(np.repeat(of, k) * max(1, len(pairs)) + pair_at[place])
        holders += np.bincount(held_by % max(1, len(pairs)), minlength=len(pairs))
        lo = hi
    u = lambda x: pack(x.astype(np.uint64))
    first = {"_pairs": u(pairs), "_holders": u(holders), "_in_run": u(n_pairs), "_pair_at": u(pair_at), "_pair_times": u(of_run),
             "_in_doc": u(np.bincount(doc, minlength=docs)), "_run_at": u(flat), "_run_times": u(times)}
    cols = {c: pa.array(own[:, i], pa.int64()) for i, c in enumerate(RESULTS[:4])}
    cols["groups_sha256"] = pa.array(shas, pa.string())
    if whole:
        cols["groups"] = pc.if_else(pa.array(good), groups, "").cast(pa.string())
    return cols | {c: pa.array([v] + [None] * (docs - 1), pa.binary()) for c, v in first.items()}


PACKED = ("_pairs", "_holders", "_in_run", "_pair_at", "_pair_times", "_in_doc", "_run_at", "_run_times")


def _blocks(df: DataFrame, path_a: str, path_b: str, text: str, whole: bool) -> DataFrame:
    """Rows ``_in`` (the input), ``_block``, ``_pos``, the documents' own figures, and the packed columns on a block's first row."""
    own = ", ".join(f"{c} long" for c in RESULTS[:4]) + ", groups_sha256 string" + (", groups string" if whole else "")
    rows = df.select(F.struct("*").alias("_in"), F.col(f"`{text}`").alias("_text"))
    schema = StructType([rows.schema["_in"], *StructType.fromDDL(f"_block long, _pos int, {own}, " + ", ".join(f"{c} binary" for c in PACKED)).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("align", path_a, path_b), lambda: Aligner(path_a, path_b))
        number = TaskContext.get().partitionId() << 32
        held_: list[pa.RecordBatch] = []
        chars = docs = 0

        def finished() -> pa.RecordBatch:
            t = pa.Table.from_batches(held_).combine_chunks().to_batches()[0]
            n = t.num_rows
            cols = {"_in": t.column(0), "_block": pa.array(np.full(n, number)), "_pos": pa.array(np.arange(n, dtype=np.int32))} | figures(t.column(1), aligner, whole)
            return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

        for batch in batches:
            for part in slices(batch, "_text"):
                held_.append(part)
                docs += part.num_rows
                chars += pc.sum(pc.binary_length(part.column(1))).as_py() or 0
                if chars >= BLOCK_CHARS or docs >= BLOCK_ROWS:
                    yield finished()
                    number, held_, chars, docs = number + 1, [], 0, 0
        if held_:
            yield finished()

    return staged(rows.mapInArrow(run, schema), "align")


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, holders in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs, holders = unpack(pairs).astype(np.int64), unpack(holders).astype(np.int64)
            for i in range(0, len(pairs), 100_000):
                p = pairs[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), block)), pa.array(np.arange(i, i + len(p), dtype=np.int32)), pa.array(p), pa.array(holders[i:i + len(p)])],
                                                 names=["block", "at", "pair", "holders"])


def _added_up(mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Answers of one block -> n_best and count_sum of its documents."""
    if not len(mine):
        return pd.DataFrame({"_block": [], "_pos": [], "n_best": [], "count_sum": []}).astype("int64")
    r = mine.iloc[0]
    get = lambda c: unpack(r[c]).astype(np.int64)
    sums = lambda x, sizes: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], np.cumsum(sizes)])])
    pair_at, pair_times, in_run, in_doc, run_at, run_times = (get(c) for c in ("_pair_at", "_pair_times", "_in_run", "_in_doc", "_run_at", "_run_times"))
    out = {"_block": np.full(len(in_doc), r["_block"]), "_pos": np.arange(len(in_doc))}
    n = len(answers)
    at = answers["at"].to_numpy(np.int64)
    for name, col in (("n_best", "best"), ("count_sum", "n")):
        value = np.zeros(n, np.int64)
        value[at] = answers[col].to_numpy(np.int64)
        per_run = sums(value[pair_at] * pair_times, in_run)
        out[name] = sums(per_run[run_at] * run_times, in_doc)
    return pd.DataFrame(out)


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", groups: bool = False) -> DataFrame:
    """``df`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, on request also ``groups``: the groups
    themselves as ``a1,a2|b1;a3|b2,b3``."""
    import sentencepiece

    wide = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    made = _blocks(df, path_a, path_b, text, groups)
    first = made.where("_pairs is not null")
    requests = first.select("_block", "_pairs", "_holders").mapInArrow(_requests, "block long, at int, pair long, holders long")
    counts = requests.groupBy("pair").agg(F.sum("holders").alias("n")).withColumn("a", F.expr(f"pair div {wide}"))
    counts = staged(counts, "align-counts")
    known = counts.join(counts.groupBy("a").agg(F.max("n").alias("top")), "a").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    answers = requests.drop("holders").join(known, "pair").select("block", "at", "n", "best")
    mine = first.select("_block", *PACKED[2:])
    added = mine.groupBy("_block").cogroup(answers.groupBy("block")).applyInPandas(_added_up, "_block long, _pos long, n_best long, count_sum long")
    results = [*RESULTS, "groups"] if groups else list(RESULTS)
    whole = made.drop(*PACKED).join(added.withColumn("_pos", F.col("_pos").cast("int")), ["_block", "_pos"])
    kept = [F.col("_in").getField(c).alias(c) for c in df.columns if c not in results]
    return whole.select(*kept, *results)
