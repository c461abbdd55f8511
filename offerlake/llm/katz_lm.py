"""Language-model scores of whole texts: a Katz back-off model of words, pairs and, with ``order`` 3, triples.

    P(w | u, v) = d(c(u, v, w)) * c(u, v, w) / c(u, v)   if the triple was seen
                = alpha(u, v) * P(w | v)                 else;   P(w | u, v) = P(w | v) if the pair u, v was never seen
    P(w | v)    = d(c(v, w)) * c(v, w) / c(v)            if the pair was seen
                = alpha(v) * P(w)                        else;   P(w | v) = P(w) if v was never seen
    P(w)        = d(c(w)) * c(w) / N                     if the word was seen, else what the seen words leave

Counts up to ``TOP`` are discounted by Good-Turing's count-of-counts, smoothed by a line through their logarithms where they
do not fall evenly; where that gives no discounts between 0 and 1 either (tiny corpora), by half a count. What a context's seen words leave goes to the others in proportion to P(w), divided by
1 minus the sum of P over its seen words, so every distribution sums to exactly 1. A context whose words all occur more than
``TOP`` times would leave nothing: there the divisor is c(v) + 1, and likewise N + 1 for single words.

The text is read once. A block of documents is kept as token numbers with a table of its distinct words (64-bit hashes), and
asks the count tables, which are partitioned by hash, only for its distinct words (which are numbered on the way) and pairs: a word or pair that fills a third
of the corpus is one entry of a block's request. A partition holds all the words that follow a context, sums them over the
blocks and answers each block; the pairs of a context with more than ``HOT`` tokens are spread over all partitions and its
sums are put together by a further aggregate. Triples go the same way, one level up: a block knows its pairs' counts by then and sends
them along, so a partition can add up P(w | v) over a context's seen words. The numbers of partitions follow the number of entries,
and only a dozen totals a level pass through the driver.

Defined cases: A-Z is lower-cased, words end at ASCII white space; a null or empty text is one end token; repeated rows are
counted and scored each; a null id is carried through and counts as held out if its remainder (0) says so; without training
documents every word is unseen with probability 1, and all scores are 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import pack, slices, staged
from offerlake.llm.common import unpack as unpacked

#: Good-Turing applies to counts up to TOP.
TOP = 5
#: Entries of a partition of the count tables on average; tokens from which a context is spread over all partitions.
WORDS_PER_PART, PAIRS_PER_PART, HOT = 1_500_000, 1_000_000, 400_000
BLOCK_ROWS = 2048
FEW = [f"m{r}" for r in range(1, TOP + 1)]
END = np.uint64(0)
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def unpack(b: bytes) -> np.ndarray:
    return unpacked(b).astype(np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(h) % np.uint64(parts)).astype(np.int64)


def _turing(n: np.ndarray) -> np.ndarray | None:
    """Katz's discounts from counts-of-counts n[0..TOP] of r = 1..TOP + 1, if all lie between 0 and 1."""
    r = np.arange(1, TOP + 1)
    k = (TOP + 1) * n[TOP] / n[0]
    if k >= 1:
        return None
    d = ((r + 1) * n[1:] / (r * n[:-1]) - k) / (1 - k)
    return np.concatenate([[0.0], d]) if (d > 0).all() and (d < 1).all() else None


def discounts(n: list[int]) -> np.ndarray:
    """d[r] for r = 0..TOP from n[r], the number of entries that occur r times (r = 1..TOP + 1); d[0] is unused.

    Good-Turing from the counts themselves; where groups of copies make them uneven, from the line through their logarithms.
    """
    seen = np.array(n[1:TOP + 2], np.float64)
    if (seen > 0).all():
        d = _turing(seen)
        if d is None:
            r = np.log(np.arange(1, TOP + 2))
            slope, at = np.polyfit(r, np.log(seen), 1)
            d = _turing(np.exp(at + slope * r))
        if d is not None:
            return d
    return np.array([0, *((r - 0.5) / r for r in range(1, TOP + 1))])


class Words:
    """P(w) by count."""

    def __init__(self, total: int, n: list[int]):
        self.total, self.d = total, discounts(n)
        held = sum(r * n[r] * (1 - self.d[r]) for r in range(1, TOP + 1))
        self.base = total if held > 0 else total + 1
        self.unseen = (held if held > 0 else 1.0) / self.base if total else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        d = np.where(c <= TOP, self.d[np.minimum(c, TOP)], 1.0)
        return np.where(c > 0, d * c / max(1, self.base), self.unseen)


def blocks(docs: DataFrame, train: Column, doc_id: str, text: str) -> DataFrame:
    """One row per block of documents: ids, train flags, tokens per document, the distinct words' hashes, token numbers."""
    kind = docs.schema[doc_id].dataType
    schema = f"block long, ids array<{kind.simpleString()}>, train array<boolean>, sizes array<int>, words binary, tokens binary, n_words long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK_ROWS):
                known: dict[bytes, int] = {}
                fresh = count(1)
                runs = [(t or "").encode("utf-8", "replace").lower().split() for t in part.column(2).to_pylist()]
                for ws in runs:
                    for w in set(ws).difference(known):
                        known[w] = next(fresh)
                tokens = np.zeros(sum(map(len, runs)) + len(runs), np.uint32)
                i = 0
                for ws in runs:  # a text's last token stays 0, the end
                    tokens[i:i + len(ws)] = np.fromiter(map(known.__getitem__, ws), np.uint32, len(ws))
                    i += len(ws) + 1
                words = np.array([END, *(xxhash.xxh64_intdigest(w) | 2 for w in known)], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)), pa.array([part.column(1).to_pylist()], pa.list_(pa.bool_())),
                     pa.array([[len(ws) + 1 for ws in runs]], pa.list_(pa.int32())), pa.array([pack(words)], pa.binary()), pa.array([pack(tokens)], pa.binary()),
                     pa.array([len(words)], pa.int64()), pa.array([len(tokens)], pa.int64())],
                    names=["block", "ids", "train", "sizes", "words", "tokens", "n_words", "n_tokens"])
                at += 1

    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    return staged(rows.mapInArrow(run, schema), "lm-blocks")


ANSWER = "block long, kind string, part long, a binary, b binary, c binary, n array<long>"


def _answers(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["block", "kind", "part", "a", "b", "c", "n"])


def word_counts(made: DataFrame, parts: int) -> DataFrame:
    """Ask the partitioned table of words: rows of ANSWER with kind ``word`` (totals and numbers in the order of the block's
    words of that partition) and ``words`` (n: [0, n_1 .. n_TOP+1, total, distinct])."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words, tokens = unpack(r["words"]), unpack(r["tokens"])
                mine = np.bincount(tokens[np.repeat(r["train"], r["sizes"])].astype(np.int64), minlength=len(words)).astype(np.uint32)
                part = _part(words, parts)
                order = np.argsort(part, kind="stable")
                cut = np.searchsorted(part[order], np.arange(parts + 1))
                got = [(p, order[cut[p]:cut[p + 1]]) for p in range(parts) if cut[p] < cut[p + 1]]
                yield pa.RecordBatch.from_pydict({"part": pa.array([p for p, _ in got], pa.int64()), "block": pa.array([r["block"]] * len(got), pa.int64()),
                                                  "words": pa.array([pack(words[i]) for _, i in got], pa.binary()), "counts": pa.array([pack(mine[i]) for _, i in got], pa.binary())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        words, counts = [unpack(b) for b in pdf["words"]], [unpack(b) for b in pdf["counts"]]
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.uint64)
        part = int(pdf["part"].iloc[0])
        n = [0, *(int((total == r).sum()) for r in range(1, TOP + 2)), int(total.sum()), int((total > 0).sum())]
        ends = np.cumsum([len(w) for w in words])
        return _answers([(-1, "words", part, None, None, None, n), *((int(b), "word", part, pack(total[at[e - len(w):e]]), pack(at[e - len(w):e].astype(np.uint64)), None, None) for b, w, e in zip(pdf["block"], words, ends, strict=True))])

    asked = made.select("block", "train", "sizes", "words", "tokens").mapInArrow(ask, "part long, block long, words binary, counts binary")
    return staged(asked.groupBy("part").applyInPandas(add, ANSWER), "lm-words")


def word_answers(words: np.ndarray, answers: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals and corpus-wide numbers (from 1) of a block's words, with one more entry: the start, counted as the end, number 0."""
    total, number = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, np.uint64)
    part = _part(words, parts)
    for p, a, b in zip(answers["part"], answers["a"], answers["b"], strict=True):
        at = np.flatnonzero(part == p)
        total[at], number[at] = unpack(a).astype(np.int64), unpack(b) * np.uint64(parts) + np.uint64(p + 1)
    total[-1] = total[0]
    return total, number


class Block:
    """A block with its words' totals: the distinct pairs of neighbours that the pair table must be asked for."""

    def __init__(self, r: pd.Series, answers: pd.DataFrame, parts: int, pair_parts: int, hot: int):
        self.words, tokens = unpack(r["words"]), unpack(r["tokens"]).astype(np.int64)
        self.sizes, self.train = np.asarray(r["sizes"], np.int64), np.asarray(r["train"], bool)
        self.count, self.number = word_answers(self.words, answers, parts)
        n = len(self.words)  # n as a first word: the start
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.concatenate([[n], tokens[:-1]])
        before[self.starts] = n
        self.tokens = tokens
        pairs, self.at = np.unique(before * n + tokens, return_inverse=True)
        self.first, self.second = np.divmod(pairs, n)
        mine = np.bincount(self.at, np.repeat(self.train, self.sizes), len(pairs)).astype(np.int64)
        self.history = self.count  # tokens that follow the word; the start: documents
        self.after = self.history[self.first]  # c(v) of every pair
        known = (self.after > 0) & (self.count[self.second] > 0)
        self.hot = self.history > hot
        spread = self.hot[self.first]
        a, b = self.number[self.first], self.number[self.second]
        part = np.where(spread, _part(_mixed(a * STEP + b), pair_parts), _part(a, pair_parts))
        self.requests = _requests(part, self.first, self.after > 0, known, self.hot[self.first], b, mine, pair_parts)


def _requests(part: np.ndarray, context: np.ndarray, entry: np.ndarray, known: np.ndarray, hot: np.ndarray, key: np.ndarray, mine: np.ndarray, parts: int) -> list[tuple]:
    """What a block asks of each partition: (partition, contexts, entries asked of each, whether more is needed of them, the entries
    asked, their keys, their training counts). ``context`` and the masks are per entry; a seen context that is followed here by
    unknown words only still needs its weight."""
    at = np.flatnonzero(entry)
    order = at[np.lexsort((context[at], part[at]))]
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    out = []
    for p in np.flatnonzero(np.diff(cut)).tolist():  # only the partitions that have an entry
        i = order[cut[p]:cut[p + 1]]
        v, first = np.unique(context[i], return_index=True)
        asks = i[known[i]]
        sizes = np.add.reduceat(known[i].astype(np.int64), first)
        lacks = np.add.reduceat((~known[i]).astype(np.int64), first) > 0
        out.append((p, v, sizes.astype(np.uint32), lacks | hot[i[first]], asks, key[asks], mine[asks].astype(np.uint32)))
    return out


class Triples:
    """A block's distinct triples, once it knows its pairs' counts: what the triple table must be asked for."""

    def __init__(self, b: Block, seen: np.ndarray, base: np.ndarray, parts: int, hot: int):
        inside = np.ones(len(b.tokens), bool)
        inside[b.starts] = False  # a text's first token has no pair before it
        at = np.flatnonzero(inside)
        before = b.at[at - 1]  # the pair that ends in the token before
        both = before * max(1, len(b.first)) + b.at[at]
        triples, inverse = np.unique(both, return_inverse=True)
        self.at = np.full(len(b.tokens), -1, np.int64)
        self.at[at] = inverse
        self.context, self.pair = np.divmod(triples, max(1, len(b.first)))
        mine = np.bincount(inverse, np.repeat(b.train, b.sizes)[at], len(triples)).astype(np.int64)
        self.history = seen[self.context]  # c(u, v): every such pair is followed by a token
        entry = self.history > 0
        known = entry & (seen[self.pair] > 0)
        spread = self.history > hot
        u, v, w = b.number[b.first[self.context]], b.number[b.second[self.context]], b.number[b.second[self.pair]]
        of_context = _mixed(u * STEP + v)
        part = np.where(spread, _part(_mixed(of_context * STEP + w), parts), _part(of_context, parts))
        self.hot = seen > hot  # by pair, as a context
        self.lower, self.base = seen[self.pair], base[b.second[self.context]]
        self.requests = _requests(part, self.context, entry, known, spread, w, mine, parts)


REQUEST = "part long, block long, u binary, v binary, hot binary, sizes binary, lacks binary, keys binary, counts binary, lower binary, base binary"


def _distinct_pairs(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (u, v) in order as rows, and the row of each."""
    order = np.lexsort((v, u))
    both = np.stack([u[order], v[order]], 1)
    new = np.concatenate([np.ones(min(1, len(u)), bool), (both[1:] != both[:-1]).any(1)])
    which = np.empty(len(u), np.int64)
    which[order] = np.cumsum(new) - 1
    return both[new], which


def _added(lower: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Sum one partition's requests over the blocks and answer them; ``lower`` gives a seen word's probability one level down."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        get = lambda c: [unpack(b) for b in pdf[c]]
        u, v, is_hot, sizes, lacks, keys = get("u"), get("v"), get("hot"), get("sizes"), get("lacks"), get("keys")
        contexts, which = _distinct_pairs(np.concatenate(u), np.concatenate(v))
        owners = np.repeat(which, np.concatenate(sizes).astype(np.int64))
        distinct, first_at, at = np.unique((owners.astype(np.uint64) << np.uint64(40)) | np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(at, np.concatenate(get("counts")), len(distinct)).astype(np.int64)
        hot_of = np.zeros(len(contexts), bool)
        hot_of[which] = np.concatenate(is_hot) > 0
        owner = owners[first_at]
        seen = total > 0
        base = np.repeat(np.concatenate(get("base")), np.concatenate(sizes).astype(np.int64)).astype(np.int64)
        p = lower(np.concatenate(get("lower")).astype(np.int64)[first_at], base[first_at])
        mass = np.bincount(owner[seen], p[seen], len(contexts))
        few = np.stack([np.bincount(owner[total == r], minlength=len(contexts)) for r in range(1, TOP + 1)], 1)
        part = int(pdf["part"].iloc[0])
        n = [0, *(int((total == r).sum()) for r in range(1, TOP + 2))]
        out = [(-1, "pairs", part, None, None, None, n)]
        out += [(-1, "hot", part, None, None, np.array([mass[c]]).tobytes(), [*contexts[c].astype(np.int64).tolist(), *few[c].tolist()]) for c in np.flatnonzero(hot_of).tolist()]
        pair_end, ctx_end = np.cumsum([len(x) for x in keys]), np.cumsum([len(x) for x in v])
        for k, block in enumerate(pdf["block"]):
            got = total[at[pair_end[k] - len(keys[k]):pair_end[k]]]
            ctx = which[ctx_end[k] - len(v[k]):ctx_end[k]]
            own = np.repeat(np.arange(len(ctx)), sizes[k].astype(np.int64))
            need = (lacks[k] > 0) | (np.bincount(own[got == 0], minlength=len(ctx)) > 0) | (few[ctx].sum(1) == 0)
            need &= ~hot_of[ctx]
            told = np.flatnonzero(need)
            out.append((int(block), "pair", part, pack(got.astype(np.uint64)), pack(np.concatenate([told, few[ctx[told]].T.ravel()]).astype(np.uint64)), mass[ctx[told]].tobytes(), None))
        return _answers(out)

    return add


def _asked(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["part", "block", "u", "v", "hot", "sizes", "lacks", "keys", "counts", "lower", "base"])


def pair_counts(made: DataFrame, words: DataFrame, known: Words, parts: int, pair_parts: int, hot: int) -> DataFrame:
    """Ask the partitioned table of pairs: rows of ANSWER with kinds ``pair`` (a block's totals and the contexts it needs),
    ``pairs`` (n: count-of-counts) and ``hot`` (a spread context's share of this partition)."""

    def ask(mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in mine.iterrows():
            b = Block(r, answers, parts, pair_parts, hot)
            for p, v, sizes, lacks, asks, key, counts in b.requests:
                none = pack(np.zeros(len(v), np.uint64))
                out.append((p, r["block"], none, pack(b.number[v]), pack(b.hot[v].astype(np.uint8)), pack(sizes), pack(lacks.astype(np.uint8)), pack(key), pack(counts),
                            pack(b.count[b.second[asks]].astype(np.uint64)), none))
        return _asked(out)

    by_block = made.select("block", "sizes", "train", "words", "tokens").groupBy("block").cogroup(words.where("kind = 'word'").groupBy("block"))
    asked = by_block.applyInPandas(ask, REQUEST)
    return staged(asked.groupBy("part").applyInPandas(_added(lambda c, _: known.p(c)), ANSWER), "lm-pairs")


def _told(requests: list[tuple], answers: pd.DataFrame, entries: int, contexts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's entries' totals, and by context the small counts (-1: not told, so there are discounted words and all entries seen)
    and the sum of the lower probabilities."""
    seen, small, mass = np.zeros(entries, np.int64), np.full((contexts, TOP), -1, np.int64), np.zeros(contexts)
    said = {int(x["part"]): x for _, x in answers[answers["kind"] == "pair"].iterrows()}
    for p, v, _, _, asks, _, _ in requests:
        seen[asks] = unpack(said[p]["a"]).astype(np.int64)
        told = unpack(said[p]["b"]).astype(np.int64).reshape(TOP + 1, -1)
        small[v[told[0]]] = told[1:].T
        mass[v[told[0]]] = np.frombuffer(said[p]["c"], np.float64)
    return seen, small, mass


def _weights(small: np.ndarray, mass: np.ndarray, history: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Divisor, back-off weight) of contexts seen ``history`` times."""
    left = ((1 - low[1:]) * np.arange(1, TOP + 1) * np.maximum(small, 0)).sum(1)
    bare = (small >= 0).all(1) & (left <= 0)
    base = np.maximum(1, np.where(bare, history + 1, history))
    return base, np.where(bare, 1.0, left) / base / np.maximum(1e-300, 1 - mass)


def _seen_p(c: np.ndarray, base: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.where(c <= TOP, low[np.minimum(c, TOP)], 1.0) * c / np.maximum(1, base)


class Pairs:
    """A block with its pairs' totals: P(w | v) of its distinct pairs, and the divisor of its words as contexts."""

    def __init__(self, b: Block, got: pd.DataFrame, known: Words, low: np.ndarray):
        self.seen, small, mass = _told(b.requests, got, len(b.first), len(b.history))
        place = {int(h): i for i, h in enumerate(b.number.tolist()) if b.hot[i]}
        for _, x in got[got["kind"] == "hot"].iterrows():
            i = place[int(x["n"][1])]
            small[i], mass[i] = x["n"][2:], float(bytes(x["c"]).decode())
        self.base, alpha = _weights(small, mass, b.history, low)
        word = known.p(b.count)
        v, w = b.first, b.second
        self.p = np.where(b.after == 0, word[w], np.where(self.seen > 0, _seen_p(self.seen, self.base[v], low), alpha[v] * word[w]))


def spread_sums(answers: DataFrame) -> DataFrame:
    """The sums of contexts that are spread over partitions: ``u, v, m1 .. m_TOP, mass``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([*(pa.array([x[i] for x in n], pa.int64()) for i in range(TOP + 2)), pa.array([float(np.frombuffer(x, np.float64)[0]) for x in b.column(1).to_pylist()], pa.float64())],
                                             names=["u", "v", *FEW, "mass"])

    rows = answers.where("kind = 'hot'").select("n", "c").mapInArrow(split, "u long, v long, " + ", ".join(f"{m} long" for m in FEW) + ", mass double")
    return rows.groupBy("u", "v").agg(*[F.sum(m).alias(m) for m in FEW], F.sum("mass").alias("mass"))


def _as_answers(asked: DataFrame, spread: DataFrame) -> DataFrame:
    """The sums of the spread contexts that blocks ask for (``block, u, v``) as rows of ANSWER with kind ``hot``."""
    return asked.join(spread, ["u", "v"]).select("block", F.lit("hot").alias("kind"), F.lit(0).cast("long").alias("part"), *[F.lit(None).cast("binary").alias(c) for c in "ab"],
                                                 F.encode(F.col("mass").cast("string"), "UTF-8").alias("c"), F.array("u", "v", *FEW).alias("n"))


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = 2, hot: int = HOT,
          words_per_part: int = WORDS_PER_PART, pairs_per_part: int = PAIRS_PER_PART) -> DataFrame:
    """Per row of ``docs``: id, train, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability).

    ``order`` 2 is a model of pairs, 3 one of triples above it.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    kind = docs.schema[doc_id].dataType.simpleString()
    # the id goes through as what it is; blocks tell rows apart by their place
    made = blocks(docs, train, doc_id, text)
    size = made.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    parts, pair_parts = max(1, -(-(size["words"] or 0) // words_per_part)), max(1, -(-(size["tokens"] or 0) // (2 * pairs_per_part)))
    words = word_counts(made, parts)
    sums = lambda df, kind, m: [r or 0 for r in df.where(F.col("kind") == kind).agg(*[F.sum(F.get("n", F.lit(i))) for i in range(m)]).first()]
    *n, total, distinct = sums(words, "words", TOP + 4)
    known = Words(total, n)
    pairs = pair_counts(made, words, known, parts, pair_parts, hot)
    low = discounts(sums(pairs, "pairs", TOP + 2))

    def wants(mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"block": [], "u": [], "v": []}, dtype="int64")]
        for _, r in mine.iterrows():
            total_of, number = word_answers(unpack(r["words"]), answers, parts)
            v = number[total_of > hot]
            out.append(pd.DataFrame({"block": r["block"], "u": 0, "v": v.astype(np.int64)}))
        return pd.concat(out)

    columns = ("block", "ids", "train", "sizes", "words", "tokens")
    word_rows = words.where("kind = 'word'")
    answers = word_rows.unionByName(pairs.where("kind = 'pair'"))
    spread = spread_sums(pairs)
    if spread.limit(1).count():
        asked = made.select("block", "words").groupBy("block").cogroup(word_rows.groupBy("block")).applyInPandas(wants, "block long, u long, v long")
        answers = answers.unionByName(_as_answers(asked, spread))

    above = None  # discounts of triples
    if order == 3:
        def ask(mine: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            out = []
            for _, r in mine.iterrows():
                b = Block(r, got[got["kind"] == "word"], parts, pair_parts, hot)
                below = Pairs(b, got, known, low)
                t = Triples(b, below.seen, below.base, pair_parts, hot)
                base = np.zeros(len(b.first), np.int64)
                base[t.context] = t.base
                for p, c, sizes, lacks, asks, key, counts in t.requests:
                    out.append((p, r["block"], pack(b.number[b.first[c]]), pack(b.number[b.second[c]]), pack(t.hot[c].astype(np.uint8)), pack(sizes), pack(lacks.astype(np.uint8)), pack(key),
                                pack(counts), pack(t.lower[asks].astype(np.uint64)), pack(base[c].astype(np.uint64))))
            return _asked(out)

        asked = made.select(*columns).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(ask, REQUEST)
        triples = staged(asked.groupBy("part").applyInPandas(_added(lambda c, base: _seen_p(c, base, low)), ANSWER), "lm-triples")
        above = discounts(sums(triples, "pairs", TOP + 2))
        told = triples.where("kind = 'pair'")
        spread = spread_sums(triples)
        if spread.limit(1).count():
            def wants_pairs(mine: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
                out = [pd.DataFrame({"block": [], "u": [], "v": []}, dtype="int64")]
                for _, r in mine.iterrows():
                    b = Block(r, got[got["kind"] == "word"], parts, pair_parts, hot)
                    c = np.flatnonzero(Pairs(b, got, known, low).seen > hot)
                    out.append(pd.DataFrame({"block": r["block"], "u": b.number[b.first[c]].astype(np.int64), "v": b.number[b.second[c]].astype(np.int64)}))
                return pd.concat(out)

            asked = made.select(*columns).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(wants_pairs, "block long, u long, v long")
            told = told.unionByName(_as_answers(asked, spread))
        answers = answers.unionByName(told.withColumn("kind", F.concat(F.lit("3"), "kind")))

    def finish(mine: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in mine.iterrows():
            b = Block(r, got[got["kind"] == "word"], parts, pair_parts, hot)
            below = Pairs(b, got, known, low)
            p = below.p[b.at]
            if above is not None:
                mine_too = got[got["kind"].str.startswith("3")].assign(kind=got["kind"].str[1:])
                t = Triples(b, below.seen, below.base, pair_parts, hot)
                seen, small, mass = _told(t.requests, mine_too, len(t.context), len(b.first))
                place = {(int(u), int(v)): i for i, (u, v, h) in enumerate(zip(b.number[b.first], b.number[b.second], t.hot, strict=True)) if h}
                for _, x in mine_too[mine_too["kind"] == "hot"].iterrows():
                    i = place[int(x["n"][0]), int(x["n"][1])]
                    small[i], mass[i] = x["n"][2:], float(bytes(x["c"]).decode())
                base, alpha = _weights(small, mass, below.seen, above)
                q = below.p[t.pair]
                q = np.where(t.history == 0, q, np.where(seen > 0, _seen_p(seen, base[t.context], above), alpha[t.context] * q))
                p = np.where(t.at >= 0, q[np.maximum(t.at, 0)] if len(q) else p, p)
            plain = np.log10((b.count + 0.5) / (total + 0.5 * (distinct + 1)))[b.tokens]
            add = lambda x: np.add.reduceat(x, b.starts)
            out.append(pd.DataFrame({"id": pd.Series(list(r["ids"]), dtype="Int64" if kind == "bigint" else "object"), "train": b.train, "n_tokens": b.sizes,
                                     "n_known": add((b.count[b.tokens] > 0).astype(np.int64)), "train_tokens": total, "base_score": add(plain), "score": add(np.log10(p))}))
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    by_block = made.select(*columns).groupBy("block").cogroup(answers.groupBy("block"))
    done = by_block.applyInPandas(finish, f"id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.withColumnRenamed("id", doc_id)
