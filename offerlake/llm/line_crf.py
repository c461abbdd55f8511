"""Quality by lines: a linear-chain conditional random field labels every line good or bad.

A line is described by its characters, words and repeats and by those of the lines before and after. The field is fitted
on a bounded sample of labelled documents (``PER_CLASS`` of each label, drawn by a hash of the id), each line taking its
document's label. A document's raw quality is the mean of the good marginals, by forward-backward, weighted by the lines'
lengths; a logistic curve, fitted on the same sample weighted back to the labels' true shares, makes it a probability.

Features are counted where the documents are; one task fits the field from the sample's features, and its few numbers go to
the tasks that score. Every document is scored whole.

Defined cases: a null text, or one without a line that holds more than white space, gets the labels' base rate; without
labelled rows of both kinds every score is that rate (0.5 if there is none); repeated rows give repeated results.
"""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import map_text, pack, unpack

#: Labelled documents of each class to learn from, on average, and documents to learn from at most.
PER_CLASS, LIMIT = 2500, 10_000
STEPS, RATE, RIDGE = 150, 0.08, 5e-3

OTHER, UPPER, LOWER, DIGIT, SPACE, MARK, SYMBOL = range(7)
#: Everyday punctuation (fixed value).
MARKS = ".,;:'\"-!?()’“”«»¿¡–—…"


def _classes() -> np.ndarray:
    out = np.full(0x3001, OTHER, np.uint8)
    for c in range(0x3000):
        ch = chr(c)
        out[c] = (SPACE if ch.isspace() else UPPER if ch.isupper() else LOWER if ch.islower() else OTHER if ch.isalpha()
                  else DIGIT if ch.isnumeric() else MARK if ch in MARKS else SYMBOL)
    return out


CLASS = _classes()
#: Columns of a line's own description that its neighbours see, too.
SEEN = (2, 5, 7, 8, 9, 10, 11)
OWN = 18
WIDTH = OWN + 2 * (len(SEEN) + 1)


def describe(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all non-blank lines of the texts, the lines' lengths, and the number of lines of each text."""
    lines: list[str] = []
    counts, repeated = [], []
    for t in texts:
        mine = [x for x in t.split("\n") if x and not x.isspace()]
        seen = Counter(mine)
        repeated += [seen[x] > 1 for x in mine]
        lines += mine
        counts.append(len(mine))
    sizes = np.array(counts, np.int64)
    if not lines:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0), sizes
    length = np.array([len(x) for x in lines], np.float64)
    code = np.frombuffer("".join(lines).encode("utf-32-le", "replace"), "<u4")
    kind = CLASS[np.minimum(code, 0x3000)]
    starts = np.concatenate([[0], np.cumsum(length[:-1])]).astype(np.int64)
    n = np.stack([np.add.reduceat(kind == k, starts, dtype=np.int64) for k in range(7)], 1).astype(np.float64)
    bangs = np.add.reduceat((code == 33) | (code == 63), starts, dtype=np.int64)
    pipes = np.add.reduceat((code == 124) | (code == 9), starts, dtype=np.int64)
    words, distinct, twice = np.zeros(len(lines)), np.zeros(len(lines)), np.zeros(len(lines))
    for i, x in enumerate(lines):
        w = x.split()
        words[i], distinct[i] = len(w), len(set(w))
        if distinct[i] < words[i]:
            twice[i] = sum(a == b for a, b in zip(w, w[1:], strict=False))
    first, last = kind[starts], kind[np.concatenate([starts[1:], [len(kind)]]) - 1]
    tail = code[np.concatenate([starts[1:], [len(kind)]]) - 1]
    letters = np.maximum(1, n[:, OTHER] + n[:, UPPER] + n[:, LOWER])
    own = np.stack([
        np.ones(len(lines)), np.log1p(length) / 5, n[:, UPPER] / letters, n[:, DIGIT] / length, n[:, MARK] / length, n[:, SYMBOL] / length,
        n[:, SPACE] / length, np.minimum(3, 3 * n[:, SYMBOL] / words), np.minimum(1, bangs / words), twice / words, 1 - distinct / words,
        np.array(repeated, np.float64), np.minimum(1, pipes / words), letters / words / 10, first == UPPER, last == SYMBOL,
        np.isin(tail, [33, 46, 63]), length < 25], 1)
    ends = np.cumsum(sizes)
    head, foot = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    head[(ends - sizes)[sizes > 0]], foot[ends[sizes > 0] - 1] = True, True
    near = own[:, SEEN]
    before = np.where(head[:, None], 0, np.roll(near, 1, 0))
    after = np.where(foot[:, None], 0, np.roll(near, -1, 0))
    return np.concatenate([own, before, head[:, None], after, foot[:, None]], 1).astype(np.float32), length, sizes


def _add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + np.squeeze(top, axis)


def forward_backward(unary: np.ndarray, turn: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (lines x 2) and the expected number of turns (2 x 2) of sequences that lie one after the other.

    Step t advances every sequence that is longer than t; they are ordered by length, so these are a prefix.
    """
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    if not len(order):
        return np.zeros((0, 2)), np.zeros((2, 2))
    at, size = starts[order], sizes[order]
    live = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0])), "right")
    ahead, back = unary.astype(np.float64).copy(), np.zeros((len(unary), 2))
    for t in range(1, len(live)):
        here = at[:live[t]] + t
        ahead[here] += _add(ahead[here - 1][:, :, None] + turn[None], 1)
    for t in range(len(live) - 1, 0, -1):
        here = at[:live[t]] + t
        back[here - 1] = _add(turn[None] + (unary[here] + back[here])[:, None, :], 2)
    both = ahead + back
    total = _add(both, 1)
    inner = np.ones(len(unary), bool)
    inner[at] = False
    here = np.flatnonzero(inner)
    pairs = np.exp(ahead[here - 1][:, :, None] + turn[None] + (unary[here] + back[here])[:, None, :] - total[here][:, None, None]).sum(0)
    return np.exp(both - total[:, None]), pairs


def train(x: np.ndarray, sizes: np.ndarray, length: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
    """Fit the field by gradient ascent on the log likelihood (Adam), then the logistic curve by Newton steps."""
    mean, std = x.mean(0), x.std(0)
    mean[0], std[0] = 0, 1
    std[std < 1e-6] = 1
    z = ((x - mean) / std).astype(np.float64)
    y = np.repeat(label, sizes)
    inner = np.ones(len(y), bool)
    inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
    seen = np.zeros((2, 2))
    for c in (0, 1):
        seen[c, c] = (inner & (y == c)).sum()
    w, turn = np.zeros((2, x.shape[1])), np.zeros((2, 2))
    moments = [np.zeros_like(a) for a in (w, w, turn, turn)]
    hot = np.eye(2)[y]
    for step in range(1, STEPS + 1):
        p, pairs = forward_backward(z @ w.T, turn, sizes)
        grads = ((hot - p).T @ z / len(z) - RIDGE * w, (seen - pairs) / len(z) - RIDGE * turn)
        for k, (a, g) in enumerate(zip((w, turn), grads, strict=True)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g * g
            a += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = {"w": (w / std).tolist(), "bias": (-(w * (mean / std)).sum(1)).tolist(), "turn": turn.tolist(), "rate": float((weight * label).sum() / weight.sum())}
    q = raw_quality(model, x, length, sizes)
    has = ~np.isnan(q)
    curve, f = np.array([1.0, 0.0]), np.stack([_logit(q[has]), np.ones(has.sum())], 1)
    t, s = label[has], weight[has]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(f @ curve, -30, 30)))
        g = f.T @ (s * (t - p)) - 1e-2 * s.mean() * (curve - [1, 0])
        h = (f * (s * p * (1 - p))[:, None]).T @ f + 1e-2 * s.mean() * np.eye(2)
        curve = curve + np.clip(np.linalg.solve(h, g), -2, 2)
    return model | {"curve": curve.tolist()}


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def line_marginals(model: dict, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return forward_backward(x @ np.array(model["w"]).T + np.array(model["bias"]), np.array(model["turn"]), sizes)[0][:, 1]


def raw_quality(model: dict, x: np.ndarray, length: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean good marginal weighted by length; nan without lines."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    good = line_marginals(model, x, sizes) if len(x) else np.zeros(0)
    with np.errstate(invalid="ignore"):
        return np.bincount(doc, good * length, len(sizes)) / np.bincount(doc, length, len(sizes))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> dict:
    """Learn from the rows of ``labels`` that satisfy ``learn`` (a condition on their id)."""
    rows = labels.select(F.col(doc_id).alias("id"), F.col(quality).alias("q")).where(learn).where("id is not null and q in (0, 1)").distinct()
    sizes = {r["q"]: r["count"] for r in rows.groupBy("q").count().collect()}
    if len(sizes) < 2:
        return {"rate": float(next(iter(sizes), 0.5))}
    rate = F.when(F.col("q") == 1, F.lit(min(1.0, PER_CLASS / sizes[1]))).otherwise(F.lit(min(1.0, PER_CLASS / sizes[0])))
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003 < rate)
    # about 2 * PER_CLASS distinct ids, however many labels there are; LIMIT holds if an id names very many documents
    sample = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(drawn), "id").select("q", "t").limit(LIMIT)

    def features(part: pa.RecordBatch) -> dict:
        x, length, sizes_ = describe([t or "" for t in part.column(1).to_pylist()])
        cut = np.cumsum(sizes_)[:-1]
        return {"n": sizes_.tolist(), "x": [pack(a.ravel()) for a in np.split(x, cut)], "len": [pack(a.astype(np.int64)) for a in np.split(length, cut)]}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "q", "x"], kind="stable")
        x = np.concatenate([unpack(b) for b in pdf["x"]]).reshape(-1, WIDTH)
        label = pdf["q"].to_numpy().astype(np.int64)
        share = {c: sizes[c] / max(1, (label == c).sum()) for c in (0, 1)}
        made = train(x, pdf["n"].to_numpy(), np.concatenate([unpack(b) for b in pdf["len"]]).astype(np.float64), label, np.where(label == 1, share[1], share[0]))
        return pd.DataFrame({"model": [json.dumps(made)]})

    # one task, over the features of the bounded sample
    made = map_text(sample, "t", "n long, x binary, len binary", features).drop("t").groupBy().applyInPandas(run, "model string").first()
    return json.loads(made["model"]) if made else {"rate": sizes[1] / sum(sizes.values())}


def score(df: DataFrame, model: dict, text: str = "text", out: str = "quality_score", lines: str | None = None) -> DataFrame:
    """Add the quality score and, if ``lines`` names a column, every non-blank line's good marginal."""

    def run(part: pa.RecordBatch) -> dict:
        x, length, sizes = describe([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
        made: dict[str, list] = {}
        if "w" in model:
            q = raw_quality(model, x, length, sizes)
            a, b = model["curve"]
            p = 1 / (1 + np.exp(-np.clip(a * _logit(q) + b, -30, 30)))
            made[out] = np.where(np.isnan(q), model["rate"], p).tolist()
        else:
            made[out] = [model["rate"]] * len(sizes)
        if lines:
            good = line_marginals(model, x, sizes) if "w" in model and len(x) else np.full(len(x), model["rate"])
            made[lines] = [a.tolist() for a in np.split(good, np.cumsum(sizes)[:-1])]
        return made

    return map_text(df, text, f"{out} double" + (f", {lines} array<double>" if lines else ""), run)
